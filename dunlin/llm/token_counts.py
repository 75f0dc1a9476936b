"""Word-piece token counts with a linear longest-match automaton.

The vocabulary is a trie whose nodes carry a failure link and the number of pieces popped when
the link is taken (both computed breadth-first, once). A word is then read character by
character, each taking a child edge or failure links; the greedy longest-match piece count is
the sum of the popped counts. No piece is ever built and no position is read twice, so a word
of any length costs linear time.

Words are runs of bytes other than ASCII white space. A word is matched as ``mark + word``
against the vocabulary, as in vocabularies whose word-initial pieces carry a mark. A word that
cannot be covered counts as one unknown token.
"""

from __future__ import annotations

from collections import Counter, deque

import pyarrow as pa
from pyspark.sql import DataFrame

MARK = "▁"
MEMO_WORDS = 200_000  # words whose counts a task remembers; a full memo is emptied


def read_pieces(model_path: str) -> list[str]:
    """Ordinary pieces of a SentencePiece model file (no control, unknown or byte pieces)."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    return [
        sp.id_to_piece(i) for i in range(sp.get_piece_size())
        if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))
    ]


class LongestMatch:
    """Automaton over the pieces. ``count(word)`` is the number of greedy pieces, or 0 if the
    word cannot be covered."""

    def __init__(self, pieces):
        edges: list[dict[str, int]] = [{}]
        final = [False]
        for piece in pieces:
            node = 0
            for c in piece:
                nxt = edges[node].get(c)
                if nxt is None:
                    nxt = edges[node][c] = len(edges)
                    edges.append({})
                    final.append(False)
                node = nxt
            final[node] = node != 0
        link = [-1] * len(edges)  # -1: none
        pops = [0] * len(edges)
        queue = deque([0])
        while queue:
            parent = queue.popleft()
            for c, node in edges[parent].items():
                queue.append(node)
                if final[node]:
                    link[node], pops[node] = 0, 1
                    continue
                at, popped = link[parent], pops[parent]
                while at >= 0 and c not in edges[at]:
                    popped += pops[at]
                    at = link[at]
                if at >= 0:
                    link[node], pops[node] = edges[at][c], popped
        self.edges, self.link, self.pops = edges, link, pops

    def count(self, word: str) -> int:
        edges, link, pops = self.edges, self.link, self.pops
        node = total = 0
        for c in word:
            nxt = edges[node].get(c)
            while nxt is None:
                total += pops[node]
                node = link[node]
                if node < 0:
                    return 0
                nxt = edges[node].get(c)
            node = nxt
        while node:
            total += pops[node]
            node = link[node]
            if node < 0:
                return 0
        return total


def _counter(shared, mark: str):
    def run(batches):
        machine = shared.value
        memo: dict[bytes, int] = {}
        for batch in batches:
            out = []
            for text in batch.column("text"):
                words = Counter((text.as_py() or "").encode().split())
                tokens = unknown = 0
                for word, n in words.items():
                    k = memo.get(word)
                    if k is None:
                        if len(memo) >= MEMO_WORDS:
                            memo.clear()
                        k = machine.count(mark + word.decode())
                        if len(word) <= 64:
                            memo[word] = k
                    tokens += n * (k or 1)
                    unknown += 0 if k else n
                out.append((words.total(), tokens, unknown))
            cols = list(zip(*out)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols)],
                names=["doc_id", "n_words", "n_tokens", "n_unknown"],
            )

    return run


def count_tokens(docs: DataFrame, pieces, mark: str = MARK) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, n_tokens, n_unknown.

    NULL and empty texts count 0; NULL and repeated doc_ids are passed through row by row;
    extra columns are ignored; an empty table gives no rows. The automaton is broadcast; its
    size is that of the vocabulary.
    """
    shared = docs.sparkSession.sparkContext.broadcast(LongestMatch(pieces))
    narrow = docs.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text")
    return narrow.mapInArrow(
        _counter(shared, mark), "doc_id bigint, n_words bigint, n_tokens bigint, n_unknown bigint")
