"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus signs, digits, schemes and
identifier cues. Each anchor is expanded by a small deterministic parser that looks at the
characters around it, finds the boundary of the candidate and validates it. Parsers read a
character at most a fixed number of times, so long texts cost linear time.

Kinds, in the order of the output:
  email, ip, card, phone   the base kinds, leftmost and non-overlapping within a kind
  login                    a URL (after one of ``SCHEMES``) that holds ``user:password@``
  secret                   a quoted value of 16 or more of ``[A-Za-z0-9_-]`` after one of ``CUES``
  iban                     two capitals, two digits, 11 to 30 capitals or digits in blocks
                           parted by single spaces, after the cue ``iban``, passing MOD 97
"""

from __future__ import annotations

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F


KINDS = ("email", "ip", "card", "phone", "login", "secret", "iban")
SCHEMES = ("http://", "https://", "ftp://")
CUES = ("token", "secret", "password", "api_key", "apikey")

_DIGITS = frozenset("0123456789")
_LETTERS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
_DOMAIN = _DIGITS | _LETTERS | {"-"}
_LOCAL = _DOMAIN | frozenset("._%+")
_PHONE = _DIGITS | frozenset(" ().-")
_VALUE = _DIGITS | _LETTERS | frozenset("_-")
_ID = _DIGITS | frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def _run(text: str, at: int, chars: frozenset) -> int:
    """End of the run of ``chars`` that begins at ``at``."""
    n = len(text)
    while at < n and text[at] in chars:
        at += 1
    return at


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


class Finder:
    """Spans of one text after another; holds the automaton."""

    def __init__(self):
        self.automaton = ahocorasick.Automaton()
        for word in ("@", "+", *sorted(_DIGITS)):
            self.automaton.add_word(word, (word if word in "@+" else "0", word))
        for kind, words in (("scheme", SCHEMES), ("cue", CUES), ("iban", ("iban",))):
            for word in words:  # cues and schemes in the cases that texts use
                for form in {word, word.upper(), word.capitalize()}:
                    self.automaton.add_word(form, (kind, form))
        self.automaton.make_automaton()

    def spans(self, text: str | None) -> list[tuple[str, int, int]]:
        """(kind, start, end) in code points, end exclusive, by kind in the order of ``KINDS``
        and then by start. None is empty."""
        if not text:
            return []
        found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
        done = dict.fromkeys(KINDS, 0)  # where the last match of a kind ended, valid or not
        runs = 0  # end of the digit chain last looked at for cards
        dots = 0  # end of the dotted chain last looked at for addresses
        for last, (kind, word) in self.automaton.iter(text):
            if kind == "0":
                if last >= runs:
                    runs = self._card(text, last, found["card"])
                if last >= dots:
                    dots = self._ip(text, last, found["ip"])
            elif kind == "@":
                self._email(text, last, found["email"], done)
            elif kind == "+":
                self._phone(text, last, found["phone"], done)
            elif kind == "scheme":
                self._login(text, last + 1 - len(word), last + 1, found["login"], done)
            elif kind == "cue":
                self._secret(text, last + 1, found["secret"], done)
            else:
                self._iban(text, last + 1, found["iban"], done)
        return [(k, a, b) for k in KINDS for a, b in found[k]]

    @staticmethod
    def _email(text, at, out, done):
        a = at
        while a > done["email"] and text[a - 1] in _LOCAL:
            a -= 1
        b = _run(text, at + 1, _DOMAIN)
        if a == at or b == at + 1:
            return
        end = 0
        while b < len(text) and text[b] == ".":
            c = _run(text, b + 1, _DOMAIN)
            if c == b + 1:
                break
            end = b = c
        if end:
            out.append((a, end))
            done["email"] = end

    @staticmethod
    def _ip(text, at, out):
        """Four dotted numbers at a time along the chain that begins at ``at``."""
        while True:
            a, ends = at, []
            while True:
                b = _run(text, at, _DIGITS)
                ends.append(b)
                if len(ends) == 4 or b + 1 >= len(text) or text[b] != "." or text[b + 1] not in _DIGITS:
                    break
                at = b + 1
            end = ends[-1]
            if len(ends) < 4:
                return end
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text[a:end].split(".")):
                out.append((a, end))
            if end + 1 >= len(text) or text[end] != "." or text[end + 1] not in _DIGITS:
                return end
            at = end + 1

    @staticmethod
    def _card(text, at, out):
        a, n, size = at, len(text), 0
        while at < n:
            if text[at] in _DIGITS:
                at += 1
                size += 1
            elif text[at] in " -" and at + 1 < n and text[at + 1] in _DIGITS:
                at += 1
            else:
                break
        if 13 <= size <= 19 and _luhn(text[a:at].replace(" ", "").replace("-", "")):
            out.append((a, at))
        return at

    @staticmethod
    def _phone(text, at, out, done):
        if at < done["phone"] or at + 1 >= len(text) or text[at + 1] not in _DIGITS:
            return
        b = _run(text, at + 2, _PHONE)
        while b > at + 3 and text[b - 1] not in _DIGITS:
            b -= 1
        if b <= at + 3:
            return
        done["phone"] = b
        if 9 <= sum(c in _DIGITS for c in text[at:b]) <= 15:
            out.append((at, b))

    @staticmethod
    def _login(text, start, at, out, done):
        if start < done["login"]:
            return
        user = _run(text, at, _LOCAL)
        if user == at or user >= len(text) or text[user] != ":":
            return
        end = user + 1
        while end < len(text) and not text[end].isspace() and text[end] not in "/@\"'<>":
            end += 1
        if end > user + 1 and end < len(text) and text[end] == "@":
            host = _run(text, end + 1, _DOMAIN | {"."})
            if host > end + 1:
                out.append((start, host))
                done["login"] = host

    @staticmethod
    def _secret(text, at, out, done):
        """cue, optional spaces, = or :, optional spaces, a quote, the value, the same quote."""
        if at < done["secret"]:
            return
        at = _run(text, at, frozenset(" "))
        if at >= len(text) or text[at] not in "=:":
            return
        at = _run(text, at + 1, frozenset(" "))
        if at >= len(text) or text[at] not in "\"'":
            return
        end = _run(text, at + 1, _VALUE)
        if end - at - 1 >= 16 and end < len(text) and text[end] == text[at]:
            out.append((at + 1, end))
            done["secret"] = end

    @staticmethod
    def _iban(text, at, out, done):
        at = _run(text, at, frozenset(" :"))
        if at < done["iban"] or at + 4 > len(text) or not set(text[at:at + 2]) <= _ID - _DIGITS:
            return
        b = at
        while b < len(text) and b - at < 42 and (
            text[b] in _ID or text[b] == " " and b + 1 < len(text) and text[b + 1] in _ID
        ):
            b += 1
        code = text[at:b].replace(" ", "")
        if 15 <= len(code) <= 34 and set(code[2:4]) <= _DIGITS:
            if int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1:
                out.append((at, b))
                done["iban"] = b


SPAN_TYPE = "array<struct<kind:string,start:int,end:int>>"


def _find(batches):
    finder = Finder()
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        spans = [
            [{"kind": k, "start": a, "end": b} for k, a, b in finder.spans(t)]
            for t in batch.column("text").to_pylist()
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(spans, kind)], names=["doc_id", "spans"])


def find_personal_data(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, spans (array of kind, start, end).

    NULL and empty texts have no spans; NULL and repeated doc_ids are passed through row by
    row; extra columns are ignored; an empty table gives no rows.
    """
    narrow = docs.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text")
    return narrow.mapInArrow(_find, f"doc_id bigint, spans {SPAN_TYPE}")


def redact(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """Replace each span by its kind in angle brackets; overlapping spans by the first one's."""
    if text is None or not spans:
        return text
    parts, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            parts += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join(parts) + text[at:]


def redact_column(text):
    """Column of the texts with their personal data replaced, for ``withColumn``. A text
    without any stays as it is, NULL included."""
    @F.pandas_udf("string")
    def apply(texts):
        finder = _shared_finder()
        return texts.map(lambda t: redact(t, finder.spans(t)) if t is not None else None)

    return apply(text)


_finder: list[Finder] = []


def _shared_finder() -> Finder:
    if not _finder:
        _finder.append(Finder())
    return _finder[0]
