"""Order-preserving packing of documents into token sequences.

Documents keep their order. A strip is a run of whole documents of one task (a few million
tokens at most, plus the document that crosses the limit); its tokens are one line that is cut
into windows of at most ``size`` tokens. A window of a power-of-two length needs no padding;
any other is padded to ``size``
(powers below ``size // 16`` are not aimed at). Cut points are document ends, sentence ends, and every
``size // 16`` tokens inside a longer sentence; cutting within a document costs a truncation
penalty, more so within a sentence. Dynamic programming over the cut points chooses the
windows of least padding plus penalties:

    best[i] = cut_cost[i] + min( min_{i-size <= j < i} best[j] + size - (i - j),
                                 best[i - 2**k] for cut points i - 2**k )

The first minimum is that of best[j] + j over a sliding window of cut points: a monotone
queue gives it in amortised constant time.
"""

from __future__ import annotations

import base64
import uuid
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SIZE = 1024
SENTENCE_CUT = 2  # penalty of a cut at a sentence end, in padding tokens
HARD_CUT = 16  # penalty of a cut within a sentence
STRIP_TOKENS = 1 << 20
MEMO_WORDS = 200_000  # words whose ids a worker remembers (about 250 bytes each)

COLUMNS = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
           "sequence_id bigint, offset bigint")


def read_ranks(path: str) -> dict[bytes, int]:
    """Byte-pair ranks of a file with one base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def windows(cuts: np.ndarray, cost: np.ndarray, size: int = SIZE) -> list[int]:
    """Indexes of ``cuts`` at which windows end. ``cuts`` are increasing positions that start
    with 0, at most ``size`` apart; ``cost`` is the penalty of a cut at each."""
    index = np.full(int(cuts[-1]) + 1, -1, np.int32)
    index[cuts] = np.arange(len(cuts))
    exact = []  # (to, from) of the windows of power-of-two lengths, size // 16 at least
    for n in (size >> k for k in range(5)):
        to = np.searchsorted(cuts, n)
        frm = index[cuts[to:] - n]
        hit = np.flatnonzero(frm >= 0)
        exact.append(np.stack([hit + to, frm[hit]]))
    pairs = np.concatenate(exact, axis=1)
    pairs = pairs[:, np.argsort(pairs[0], kind="stable")]
    exact_to, exact_from = [*pairs[0].tolist(), -1], pairs[1].tolist()
    spots, costs = cuts.tolist(), cost.tolist()
    best, came = [0.0], [0]
    # monotone queue from ``head`` on: increasing best + position, and whose they are
    keys, owners, head = [0.0], [0], 0
    at_pair = 0
    for k in range(1, len(spots)):
        at = spots[k]
        oldest = at - size
        while spots[owners[head]] < oldest:
            head += 1
        low, frm = keys[head] + size - at, owners[head]
        while exact_to[at_pair] == k:
            j = exact_from[at_pair]
            at_pair += 1
            if best[j] <= low:
                low, frm = best[j], j
        low += costs[k]
        best.append(low)
        came.append(frm)
        key = low + at
        while len(keys) > head and keys[-1] >= key:
            keys.pop()
            owners.pop()
        keys.append(key)
        owners.append(k)
    out, k = [], len(spots) - 1
    while k:
        out.append(k)
        k = came[k]
    return out[::-1]


def cut_points(lengths: np.ndarray, ends: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Cut positions and their penalties for documents of these token lengths; ``ends`` are
    the positions after which a sentence ends."""
    docs = np.cumsum(lengths)
    kind = np.zeros(int(docs[-1]) + 1, np.uint8)  # 1 hard cut, 2 sentence end, 3 document end
    kind[ends] = 2
    kind[docs] = 3
    kind[0] = 3
    cuts = np.flatnonzero(kind)
    step = size // 16
    more = (np.diff(cuts) - 1) // step  # hard cuts inside each gap
    gap = np.repeat(np.arange(len(more)), more)
    nth = np.arange(len(gap)) - np.repeat(np.cumsum(more) - more, more) + 1
    kind[cuts[gap] + nth * step] = 1
    cuts = np.flatnonzero(kind)
    return cuts, np.array([0, HARD_CUT, SENTENCE_CUT, 0], float)[kind[cuts]]


def _pack_strip(ids: list, docs: list[bytes], is_end: np.ndarray, first: int, size: int):
    """Arrow batch of the pieces of one strip, whose sequences are numbered from ``first`` on,
    and the next free number; a document is its ids as little-endian uint32."""
    lengths = np.array([len(d) // 4 for d in docs], np.int64)
    line = b"".join(docs)
    ends = np.flatnonzero(is_end[np.frombuffer(line, "<u4")]) + 1
    cuts, cost = cut_points(lengths, ends, size)
    stops = cuts[windows(cuts, cost, size)]
    doc_ends = np.cumsum(lengths)
    doc_starts = doc_ends - lengths
    # pieces: between neighbours among window ends and document ends
    marks = np.unique(np.concatenate([[0], stops, doc_ends]))
    a, b = marks[:-1], marks[1:]
    doc = np.searchsorted(doc_ends, a, side="right")
    seq = np.searchsorted(stops, a, side="right")
    seq_start = np.concatenate([[0], stops])[seq]
    view = memoryview(line)
    crc = [zlib.crc32(view[4 * x:4 * y]) for x, y in zip(a.tolist(), b.tolist())]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()).take(pa.array(doc)),
         *(pa.array(x, pa.int64()) for x in (
             a - doc_starts[doc], b - a, crc, lengths[doc], first + seq, a - seq_start))],
        names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    )
    return batch, first + len(stops) + 1


class _Memo(dict):
    """Ids of ``lead + word`` by word, as little-endian uint32; filled on demand, emptied when
    full."""

    def __init__(self, whole, lead: str, limit: int):
        self.whole, self.lead, self.limit = whole, lead, limit
        self.stops = {c: whole(c) for c in ".,"}

    def __missing__(self, word: str) -> bytes:
        if word[-1:] in self.stops and word[-2:-1].isalpha():  # a stop after a letter stands alone
            ids = self[word[:-1]] + self.stops[word[-1]]
        else:
            ids = self.whole(self.lead + word)
        if len(word) <= 64:
            if len(self) >= self.limit:
                self.clear()
            self[word] = ids
        return ids


class Encoder:
    """Ids of texts as little-endian uint32, with a memo of words.

    The splitting pattern lets a token hold white space only as one leading space or as a run
    of its own, and never looks back. So a text whose white space comes in single spaces and
    line breaks can be cut before each space and around each line break, and the parts
    encoded one by one. Other texts are encoded whole.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, limit: int = MEMO_WORDS):
        import tiktoken

        self.plain = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.words, self.firsts = _Memo(self.whole, " ", limit), _Memo(self.whole, "", limit // 4)
        self.line_break = self.whole("\n")

    def whole(self, text: str) -> bytes:
        return array("I", self.plain.encode_ordinary(text)).tobytes()

    def encode(self, text: str) -> bytes:
        if " ".join(text.split()) != text.replace("\n", " "):
            return self.whole(text)
        get, lines = self.words.__getitem__, []
        for line in text.split("\n"):
            first, *rest = line.split(" ")
            lines.append(self.firsts[first] + b"".join(map(get, rest)))
        return self.line_break.join(lines)


_encoders: dict[str, tuple[Encoder, np.ndarray]] = {}


def _encoder(key: str, shared, pattern: str, end_id: int) -> tuple[Encoder, np.ndarray]:
    """Encoder and sentence-end flags by id; made once for all tasks of a worker."""
    if key not in _encoders:
        ranks = shared.value
        is_end = np.zeros(max(max(ranks.values()), end_id) + 1, bool)
        for token, rank in ranks.items():
            is_end[rank] = token.strip(b" \"')]")[-1:] in (b".", b"!", b"?") or b"\n" in token
        _encoders.clear()
        _encoders[key] = Encoder(ranks, pattern), is_end
    return _encoders[key]


def _packer(shared, pattern: str, end_id: int, size: int, strip_tokens: int):
    key = uuid.uuid4().hex

    def rows(batches):
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                yield doc_id, text.as_py() or ""

    def run(batches):
        from pyspark import TaskContext

        encoder, is_end = _encoder(key, shared, pattern, end_id)
        end = array("I", [end_id]).tobytes()
        free = TaskContext.get().partitionId() << 40
        ids: list = []
        docs: list[bytes] = []
        held = 0
        for doc_id, text in rows(batches):
            found = encoder.encode(text) + end
            ids.append(doc_id)
            docs.append(found)
            held += len(found) // 4
            if held >= strip_tokens:
                batch, free = _pack_strip(ids, docs, is_end, free, size)
                yield batch
                ids, docs, held = [], [], 0
        if docs:
            yield _pack_strip(ids, docs, is_end, free, size)[0]

    return run


def pack(docs: DataFrame, ranks: dict[bytes, int], pattern: str, end_id: int = 0, size: int = SIZE,
         strip_tokens: int = STRIP_TOKENS) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text) in sequences of at most ``size`` (a power of two)
    tokens: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's tokens are those of the byte-pair ``ranks`` with the splitting ``pattern``,
    then ``end_id``; each lies in exactly one piece. Documents follow each other as the table
    holds them; nothing is shuffled, and a task that runs again gives the same pieces.
    ``sequence_id`` is unique: the partition, then in 40 bits the number in the partition. NULL
    and empty texts are the single ``end_id``; NULL and repeated doc_ids are kept row by row;
    extra columns are ignored; an empty table gives no rows. The ranks are broadcast; their
    size is that of the vocabulary.
    """
    if size & (size - 1) or size < 16:
        raise ValueError("size must be a power of two, 16 at least")
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    narrow = docs.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text")
    return narrow.mapInArrow(_packer(shared, pattern, end_id, size, strip_tokens), COLUMNS)
