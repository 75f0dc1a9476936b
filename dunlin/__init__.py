"""Contact, payment and conversation analytics as plain PySpark DataFrame functions.

* ``functions``  column helpers (dates, text, banding, flags)
* ``operators``  joins, windows, aggregates, ranking, measures
* ``sources``    scans and sinks
* ``plans``      the reports, one function each
* ``streaming``  the three reports that also run continuously
* ``catalog``    the registered queries over the driver tables and their oracle SQL
"""
