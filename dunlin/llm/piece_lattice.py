"""SentencePiece encoding and decoding as relations.

A word (a run of characters other than ASCII white space, led by the mark "▁") is encoded by
the best path through the lattice of its pieces: explode its substrings of bounded length,
equi-join them to the piece table, group the matching edges by word, and fold the edges, in
the order of their ends, with the higher-order function ``aggregate`` (Viterbi). The best path
has the largest sum of scores; of equal sums the one whose last piece is longer. A character
that is no piece is spelt in byte pieces, so decoding gives back every word.

Only distinct words go through the lattice. Words above ``MAX_WORD`` characters are folded
whole by the same rule where they are (``best_path``), since their edges would make groups
without a bound. Texts are read once, in parts of some documents: a part numbers its distinct
words and keeps its documents as these numbers. The words of the parts are dealt into buckets by
their hash, where they meet their encodings and go back to their part as one row for each bucket,
so no occurrence of a word is shuffled by itself. The encodings of the most frequent words, a
table of bounded size, are sent to every executor instead. The numbers then give the ids of a
document, in the order of its words.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections import Counter, defaultdict
from contextlib import contextmanager
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from dunlin.llm.common import drop_stage, stage
from dunlin.sources.checkpoints import new_folder

MARK = "▁"
_MARK = MARK.encode()
MAX_WORD = 64  # longest word whose edges are grouped
FREQUENT_WORDS = 200_000
COUNTED_WORDS = 50_000  # words a task counts before it passes the counts on
PART_WORDS = 10_000  # words whose lattices one task holds
PART_DOCS = 4_000  # documents of a part at most
PART_DISTINCT = 300_000  # distinct words after which a part of documents ends
BUCKET_WORDS = 200_000  # words of all parts that meet their encodings in one group
MOST_BUCKETS = 10_000  # tasks that parts are dealt to at most
BATCH_DOCS = 500  # documents of an Arrow batch
ZIPF_SHIFT = 1000.0
UNKNOWN = -10.0  # added to the least score for a character spelt in bytes


def read_model(path: str) -> list[tuple[str, int, float, str, int | None]]:
    """(piece, id, score, bytes in hex, byte value) of a SentencePiece model file; control and
    unknown pieces are left out.

    The file's scores are ranks of merges, whose sums mean nothing. Merges were made by falling
    frequency, so the rank stands for a frequency by Zipf's law: the score is the logarithm of
    1 / (rank + ZIPF_SHIFT), which a path can add up."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    out = []
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            out.append((piece, i, 0.0, piece[3:5], int(piece[3:5], 16)))
        elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            out.append((piece, i, -math.log(ZIPF_SHIFT - sp.get_score(i)), piece.encode().hex().upper(), None))
    return out


def piece_table(spark: SparkSession, model: list[tuple]) -> DataFrame:
    return spark.createDataFrame(model, "piece string, id int, score double, hex string, byte int")


def split_words(text: bytes | None) -> list[bytes]:
    """Words of a text, each with its mark; NULL and empty texts have none."""
    return [_MARK + w for w in (text or b"").split()]  # ASCII white space


def _texts(batch):
    """The texts of a batch, or the packed words of its rows, one at a time."""
    if "words" in batch.schema.names:
        return (_unpack_bytes(x.as_py()) for x in batch.column("words"))
    return (x.as_py() for x in batch.column("text").cast(pa.large_binary()))


def _pack_bytes(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _unpack_bytes(packed: bytes) -> bytes:
    size = int.from_bytes(packed[:8], "little")
    return pa.decompress(packed[8:], size, "zstd", asbytes=True) if size else b""


def _pack(numbers: np.ndarray) -> bytes:
    """Numbers as 32-bit integers, their first bytes together, then the second ones, and so on."""
    return _pack_bytes(numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(_unpack_bytes(packed), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<i4").reshape(-1)


def _count_words(batches):
    """(word, n) of the texts of a task; many words give several rows of a word. A packed column
    ``n`` says how often each word of a row counts."""
    seen = Counter()
    for batch in batches:
        times = batch.column("n") if "n" in batch.schema.names else None
        for k, text in enumerate(_texts(batch)):
            if times is None:
                seen.update(split_words(text))
            else:
                for word, n in zip(split_words(text), _unpack(times[k].as_py()).tolist()):
                    seen[word] += n
            if len(seen) > COUNTED_WORDS:
                yield _counts(seen)
                seen = Counter()
    yield _counts(seen)


def _counts(seen: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(seen.keys(), pa.binary()).cast(pa.string()), pa.array(seen.values(), pa.int64())], names=["word", "n"])


# One step of the fold: ``done`` holds the best (score, -start, id) up to each place, ``now``
# the best found so far for the next place. Edges come by their ends; a character that is no
# piece has no id.
_STEP = """
(s, e) -> if(e.stop > size(s.done),
    named_struct('done', array_append(s.done, s.now), 'now', named_struct(
        'score', if(e.start = size(s.done), s.now, element_at(s.done, e.start + 1)).score + e.score,
        'back', -e.start, 'id', e.id)),
    named_struct('done', s.done, 'now', greatest(s.now, named_struct(
        'score', element_at(s.done, e.start + 1).score + e.score, 'back', -e.start, 'id', e.id))))
"""
_STATE = "struct<done:array<struct<score:double,back:int,id:int>>,now:struct<score:double,back:int,id:int>>"


def best_path(word: str, pieces: dict[str, tuple[int, float]], longest: int, unknown: float,
              spelling: dict[int, int]) -> list[int]:
    """Ids of the best path of a word of any length; time and memory grow with its length."""
    scores, back = [0.0], [0]
    for stop in range(1, len(word) + 1):
        best, start = None, 0
        for k in range(max(0, stop - longest), stop):  # of equal sums the longer last piece
            edge = pieces.get(word[k:stop])
            if edge is not None or k == stop - 1:
                score = scores[k] + (unknown if edge is None else edge[1])
                if best is None or score > best:
                    best, start = score, k
        scores.append(best)
        back.append(start)
    out, stop = [], len(word)
    while stop:
        start = back[stop]
        edge = pieces.get(word[start:stop])
        out.append([edge[0]] if edge else [spelling[b] for b in word[start:stop].encode()] if spelling else [0])
        stop = start
    return [i for ids in reversed(out) for i in ids]


def _fold_long(shared, names: list[str]):
    def run(batches):
        for batch in batches:
            ids = [best_path(w, *shared.value) for w in batch.column("word").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(ids, pa.list_(pa.int32()))], names=[*names, "ids"])

    return run


def encode_words(words: DataFrame, model: list[tuple], keep: tuple[str, ...] = ()) -> DataFrame:
    """(word, *keep, ids) of a frame of distinct words (word), none of them empty. The piece
    table is broadcast; its size is that of the vocabulary.

    Only the words are shuffled, into as many parts as their number asks for; a part's
    substrings are exploded, joined and grouped where they are, and fit in memory. Words above
    MAX_WORD characters are dealt into parts by their characters instead."""
    spark = words.sparkSession
    table = piece_table(spark, model)
    pieces = table.where("byte is null").select("piece", "id", "score")
    longest = max((len(m[0]) for m in model if m[4] is None), default=1)
    unknown = min((m[2] for m in model if m[4] is None and m[2] > -1e8), default=0.0) + UNKNOWN
    codes = ", ".join(f"'{m[3]}', {m[1]}" for m in model if m[4] is not None)
    spelt = f"""transform(sequence(1, length(hex(substr(word, i, 1))), 2),
        k -> element_at(map({codes}), substr(hex(substr(word, i, 1)), k, 2)))""" if codes else "array(0)"
    staged = words if hasattr(words, "_staged_at") else stage(words.select("word", *keep), "words")
    is_long = F.length("word") > MAX_WORD
    n, long_chars = staged.agg(F.count(F.lit(1)), F.sum(F.when(is_long, F.length("word")))).first()
    parts = max(1, -(-n // PART_WORDS))
    subs = (
        staged.select("word", *keep).where(~is_long).repartition(parts, "word")
        .select("word", *keep, F.explode(F.expr("sequence(1, length(word))")).alias("stop"))
        .select("word", *keep, "stop", F.explode(F.expr(
            f"sequence(greatest(0, stop - {longest}), stop - 1)")).alias("start"))
        .select("word", *keep, "start", "stop", F.expr("substr(word, start + 1, stop - start)").alias("piece"))
    )
    # an edge for each piece, and for each character that is none
    found = subs.join(F.broadcast(pieces), "piece", "left").where("id is not null or stop = start + 1")
    edge = F.struct("stop", "start", F.coalesce("score", F.lit(unknown)).alias("score"), "id")
    edges = found.groupBy("word", *keep).agg(F.sort_array(F.collect_list(edge)).alias("edges"))
    start = f"""cast(named_struct('done', array(named_struct('score', 0D, 'back', 0, 'id', 0)), 'now', null) as {_STATE})"""
    path = F.expr(f"aggregate(edges, {start}, {_STEP}, s -> array_append(s.done, s.now))")
    ids = F.expr(f"""
        aggregate(sequence(size(best) - 1, 1, -1), named_struct('at', size(best) - 1, 'ids', cast(array() as array<int>)),
            (s, i) -> if(i = s.at,
                named_struct('at', -element_at(best, i + 1).back, 'ids', concat(
                    if(element_at(best, i + 1).id is null, {spelt}, array(element_at(best, i + 1).id)), s.ids)), s),
            s -> s.ids)
    """)
    short = edges.select("word", *keep, path.alias("best")).select("word", *keep, ids.alias("ids"))
    if not long_chars:
        return short
    shared = spark.sparkContext.broadcast((
        {m[0]: (m[1], m[2]) for m in model if m[4] is None}, longest, unknown, {m[4]: m[1] for m in model if m[4] is not None}))
    names = ["word", *keep]
    whole = staged.select(*names).where(is_long).repartition(max(1, -(-long_chars // (PART_WORDS * MAX_WORD))), "word")
    kinds = ", ".join(f"{c} {staged.schema[c].dataType.simpleString()}" for c in names)
    return short.unionByName(whole.mapInArrow(_fold_long(shared, names), f"{kinds}, ids array<int>"))


def decode(encoded: DataFrame, model: list[tuple], ids: str = "ids", out: str = "text") -> DataFrame:
    """``encoded`` with a column of the text its ids spell; marks become spaces. Unknown ids
    and NULL arrays give NULL."""
    by_id = {m[1]: bytes.fromhex(m[3]) for m in model}
    spark = encoded.sparkSession
    spelling = spark.sparkContext.broadcast(by_id)

    @F.pandas_udf("string")
    def spell(column):
        table = spelling.value

        def one(x):
            if x is None:
                return None
            try:
                return b"".join(map(table.__getitem__, x.tolist())).decode(errors="replace").replace(MARK, " ")
            except KeyError:
                return None

        return column.map(one)

    return encoded.withColumn(out, spell(F.col(ids)))


@contextmanager
def _setting(spark: SparkSession, name: str, value):
    """A session setting for the queries that run inside."""
    before = spark.conf.get(name)
    spark.conf.set(name, str(value))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _grouped_by_hash(spark: SparkSession):
    """Let a task group the edges of a part's words by hash instead of by sort, which Spark falls
    back to above 128 groups: a part holds about PART_WORDS words of bounded length."""
    return _setting(spark, "spark.sql.objectHashAggregate.sortBased.fallbackThreshold", 2 * PART_WORDS)


def _small_batches(spark: SparkSession):
    """Let tasks hold the words of few documents at a time, in the JVM and in Python."""
    return _setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_DOCS)


def _less_disk(spark: SparkSession):
    """Delete the shuffle files of a query when it ends."""
    return _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def _number_words(docs: int, words: int):
    """Parts of at most so many documents, each ended when it has so many distinct words: its
    distinct words (without marks) by falling number of occurrences, these numbers, and the
    places of its documents' words among them (``_part``)."""

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId() << 32
        ids, texts, numbers = [], [], defaultdict(count().__next__)
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), _texts(batch)):
                found = (text or b"").split()  # ASCII white space
                ids.append(doc_id)
                texts.append(np.fromiter(map(numbers.__getitem__, found), np.int32, len(found)))
                if len(ids) >= docs or len(numbers) >= words:
                    yield _part(part, ids, texts, numbers)
                    part += 1
                    ids, texts, numbers = [], [], defaultdict(count().__next__)
        if ids:
            yield _part(part, ids, texts, numbers)

    return run


def _part(part: int, ids: list, texts: list[np.ndarray], numbers: dict[bytes, int]) -> pa.RecordBatch:
    sizes, places = [len(t) for t in texts], np.concatenate(texts)
    texts.clear()
    times = np.bincount(places, minlength=len(numbers))
    order = np.argsort(-times, kind="stable")
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    words = list(numbers)
    numbers.clear()
    packed = [_pack(rank[places]), _pack_bytes(b" ".join([words[k] for k in order])), _pack(times[order])]
    pa.default_memory_pool().release_unused()
    return pa.RecordBatch.from_arrays(
        [pa.array([part]), pa.array([ids], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int32())),
         *(pa.array([x], pa.binary()) for x in packed), pa.array([len(words)], pa.int64())],
        names=["part", "doc_ids", "n_words", "places", "words", "n", "n_distinct"])


def _by_bucket(words: list[bytes], buckets: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Buckets that words (without marks) fall into by their hash, and the places of their words."""
    mark = zlib.crc32(_MARK)
    bucket = np.fromiter((zlib.crc32(w, mark) % buckets for w in words), np.int32, len(words))
    order = np.argsort(bucket, kind="stable")
    starts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    return bucket[order[starts]], np.split(order, starts[1:]) if words else []


def _deal_words(buckets: int, frequent=None):
    """A row for each part and bucket: the part's words that fall there, without the frequent
    ones, how far each stands after the one before among the part's words, and how often each
    occurs."""

    def run(batches):
        known = frequent.value[0] if frequent else {}
        for batch in batches:
            for part, text, n in zip(batch.column("part").to_pylist(), _texts(batch), batch.column("n").to_pylist()):
                words, times = text.split(), _unpack(n)
                places = np.array([k for k, w in enumerate(words) if w not in known], np.int32)
                found, rows = _by_bucket([words[k] for k in places], buckets)
                rows = [places[row] for row in rows]
                packed = zip(*((_pack(np.diff(row, prepend=0)), _pack_bytes(b" ".join([words[k] for k in row])), _pack(times[row]))
                               for row in rows))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(found), pa.array(np.full(len(rows), part)), *(pa.array(x, pa.binary()) for x in packed)],
                        names=["bucket", "part", "places", "words", "n"])

    return run


def _deal_encodings(buckets: int):
    """A row for each batch of encoded words and bucket: the words, the sizes of their encodings,
    and these end to end."""

    def run(batches):
        for batch in batches:
            words = [w[len(_MARK):] for w in batch.column("word").cast(pa.binary()).to_pylist()]
            flat, sizes, starts = _lists(batch.column("ids"))
            found, rows = _by_bucket(words, buckets)
            packed = zip(*((_pack_bytes(b" ".join([words[k] for k in row])), _pack(sizes[row]),
                            _pack(flat[_runs(starts[row], sizes[row])])) for row in rows))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found), *(pa.array(x, pa.binary()) for x in packed)], names=["bucket", "words", "sizes", "ids"])

    return run


def _encode_rows(dealt: pa.Table, encoded: pa.Table) -> pa.Table:
    """The encodings of the words of each row of a bucket."""
    numbers = {w: k for k, w in enumerate(w for text in _texts(encoded) for w in text.split())}
    sizes, flat = _joined(encoded, "sizes"), _joined(encoded, "ids")
    starts = np.cumsum(sizes) - sizes
    out = []
    for text in _texts(dealt):
        found = np.array([numbers[w] for w in text.split()])
        out.append((_pack(sizes[found]), _pack(flat[_runs(starts[found], sizes[found])])))
    sizes, ids = zip(*out) if out else ((), ())
    return pa.table({"part": dealt.column("part"), "places": dealt.column("places"),
                     "sizes": pa.array(sizes, pa.binary()), "ids": pa.array(ids, pa.binary())})


def _joined(table: pa.Table, column: str) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int32), *(_unpack(x) for x in table.column(column).to_pylist())])


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of runs laid end to end."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def _lists(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values of a list column, the length of each list and its start."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), sizes, np.cumsum(sizes) - sizes


def _put_back(frequent):
    """Ids of the documents of a part from those of its words: the frequent ones, and the others,
    which come by buckets."""

    def run(parts: pa.Table, encoded: pa.Table) -> pa.Table:
        known, known_ids, known_sizes = frequent.value
        numbers = np.array([known.get(w, -1) for w in next(_texts(parts)).split()], np.int32)
        places = np.concatenate([np.flatnonzero(numbers >= 0), *(
            np.cumsum(_unpack(x)) for x in encoded.column("places").to_pylist())]).astype(np.int64)
        order = np.argsort(places)  # by the place among the part's words
        if not np.array_equal(places[order], np.arange(len(numbers))):
            raise ValueError("a word of a part has no encoding, or several")
        numbers = numbers[numbers >= 0]
        starts, sizes = np.cumsum(known_sizes) - known_sizes, known_sizes[numbers]
        ids = np.concatenate([known_ids[_runs(starts[numbers], sizes)], _joined(encoded, "ids")])
        sizes = np.concatenate([sizes, _joined(encoded, "sizes")])
        starts, sizes = (np.cumsum(sizes) - sizes)[order], sizes[order]
        return _documents(parts, starts, sizes, ids)

    return run


def _documents(parts: pa.Table, starts: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> pa.Table:
    doc_ids, n_words = parts.column("doc_ids")[0].values, parts.column("n_words")[0].values.to_numpy()
    words, ends = _unpack(parts.column("places")[0].as_py()), np.concatenate([[0], np.cumsum(n_words)])
    out = []
    for k in range(0, len(n_words), BATCH_DOCS):
        n = n_words[k:k + BATCH_DOCS]
        found = words[ends[k]:ends[k + len(n)]]
        edges = np.concatenate([[0], np.cumsum(sizes[found])])[ends[k:k + len(n) + 1] - ends[k]]
        out.append(pa.RecordBatch.from_arrays(
            [doc_ids.slice(k, len(n)), pa.array(n, pa.int64()), pa.array(np.diff(edges), pa.int64()), pa.ListArray.from_arrays(
                pa.array(edges, pa.int32()), pa.array(ids[_runs(starts[found], sizes[found])], pa.int32()))],
            names=["doc_id", "n_words", "n_tokens", "ids"]))
    pa.default_memory_pool().release_unused()
    return pa.Table.from_batches(out)


def _bucketed(df: DataFrame, n: int, column: str, name: str) -> DataFrame:
    """``df`` staged in ``n`` buckets of ``column``, which later steps group without a shuffle.
    The table's name is forgotten; the files stay."""
    spark, table, path = df.sparkSession, f"{name}_{uuid.uuid4().hex}", new_folder(df.sparkSession, name)
    with _less_disk(spark):
        (df.repartition(n, column).write.format("parquet").bucketBy(n, column)
         .option("path", path).option("compression", "zstd").saveAsTable(table))
    out = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return out


def encode_documents(docs: DataFrame, model: list[tuple], frequent: int = FREQUENT_WORDS) -> tuple[DataFrame, DataFrame]:
    """(documents, words): one row per row of ``docs`` (doc_id, text) with doc_id, n_words,
    n_tokens, ids (of all its words, in order), and the staged encodings (word, n, ids) of all
    distinct words. The ``frequent`` most frequent words are sent to every executor; the result is
    the same for any number.

    NULL and empty texts have no words; NULL and repeated doc_ids are passed through row by
    row; extra columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    texts = docs.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text")
    n_parts = max(1, min(MOST_BUCKETS, -(-8 * texts.count() // PART_DOCS)))  # few parts meet in one task
    with _small_batches(spark):
        parts = _bucketed(
            texts.mapInArrow(
                _number_words(PART_DOCS, PART_DISTINCT),
                "part bigint, doc_ids array<bigint>, n_words array<int>, places binary, words binary, n binary, n_distinct bigint"),
            n_parts, "part", "numbered_words")
    buckets = max(1, -(-(parts.agg(F.sum("n_distinct")).first()[0] or 0) // BUCKET_WORDS))
    listed, row = parts.select("part", "words", "n"), "bucket int, part bigint, places binary, words binary, n binary"
    with _less_disk(spark):
        counted = stage(
            listed.mapInArrow(_deal_words(buckets), row).select("bucket", "words", "n").repartition(buckets, "bucket")
            .mapInArrow(_count_words, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")),
            "distinct-words", compression="zstd")
        with _grouped_by_hash(spark):
            words = stage(encode_words(counted, model, keep=("n",)), "encoded-words", compression="zstd")
        drop_stage(counted)
        share = max(0.0, 1 - frequent / max(1, words.count()))  # words below this share are not sorted
        least = words.agg(F.percentile_approx("n", share)).first()[0]
        top = words.where((F.length("word") <= MAX_WORD) & (F.col("n") >= F.lit(least))).orderBy(F.desc("n"), "word").limit(frequent).select("word", "ids").toArrow()
        flat, sizes, _ = _lists(top.column("ids").combine_chunks()) if len(top) else (np.zeros(0, np.int32),) * 3
        shared = spark.sparkContext.broadcast((
            {w[len(_MARK):]: k for k, w in enumerate(top.column("word").cast(pa.binary()).to_pylist())}, flat, sizes))
        known = words.select("word", "ids").mapInArrow(
            _deal_encodings(buckets), "bucket int, words binary, sizes binary, ids binary")
        encoded = stage(
            listed.mapInArrow(_deal_words(buckets, shared), row).drop("n").repartition(buckets, "bucket").groupBy("bucket")
            .cogroup(known.repartition(buckets, "bucket").groupBy("bucket"))
            .applyInArrow(_encode_rows, "part bigint, places binary, sizes binary, ids binary"),
            "part-words", compression="zstd")
    out = (
        parts.select("part", "doc_ids", "n_words", "places", "words").groupBy("part")
        .cogroup(encoded.repartition(n_parts, "part").groupBy("part"))
        .applyInArrow(_put_back(shared), "doc_id bigint, n_words bigint, n_tokens bigint, ids array<int>")
    )
    return out, words
