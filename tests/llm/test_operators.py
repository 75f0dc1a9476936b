"""Corpus operators on small frames: brute force, and NULLs, empty, long, tied and repeated rows."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dunlin.llm import (
    components, digest_index, html_text, jaccard_join, packing, piece_lattice, pii, queries, rp_forest, suffix_dedup,
    token_counts, toxicity,
)

ODD = [(None, "no id here at all"), (1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (5, "a b c d e f g"),
       (6, "word " * 30_000), (7, "x" * 5_000), (8, "é" * 300 + " ß")]


def random_text(rng, n):
    words = ["the", "of", "ab.", "Éa", "b-c", "12", "long", "x,y", "(z)"]
    return "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\n", "  ", "\t"]) for _ in range(n))


def test_token_counts_match_greedy_pieces(frame):
    pieces = token_counts.read_pieces(queries.PIECES)
    known = set(pieces)

    def greedy(word):
        at = n = 0
        while at < len(word):
            end = next((e for e in range(min(len(word), at + 20), at, -1) if word[at:e] in known), None)
            if end is None:
                return 0
            at, n = end, n + 1
        return n

    rng = random.Random(1)
    rows = [*ODD, *((k, random_text(rng, 40)) for k in range(10, 30)), (31, "ok \U0001F9FFx fine")]
    got = token_counts.count_tokens(frame(rows), pieces).collect()
    for (doc_id, text), r in zip(rows, got):
        counts = [greedy("▁" + w.decode()) for w in (text or "").encode().split()]
        assert (r.doc_id, r.n_words, r.n_tokens, r.n_unknown) == (
            doc_id, len(counts), sum(c or 1 for c in counts), counts.count(0))
    machine = token_counts.LongestMatch(["a", "ab", "abc", "b", "bcd"])
    assert [machine.count(w) for w in ("abcd", "abx", "", "abab", "bcd")] == [0, 0, 0, 2, 1]
    assert token_counts.count_tokens(frame([]), pieces).collect() == []


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def base_spans(text):
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(len(p.lstrip("0")) > 3 or int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            yield kind, *m.span()


def test_personal_data_base_kinds_equal_the_patterns():
    finder, rng = pii.Finder(), random.Random(2)
    for _ in range(20_000):
        letters = rng.choice(["0123.", "0127 -", "+0 1()-.", "a@b.-1", "a@.+1 -0é"])
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        assert [s for s in finder.spans(text) if s[0] in BASE] == list(base_spans(text)), text


def test_personal_data_more_kinds_and_edges(frame):
    text = 'see ftp://bob:pw@host.example/x token = "abcdefghij0123456789" IBAN GB82 WEST 1234 5698 7654 32.'
    spans = pii.Finder().spans(text)
    assert [text[a:b] for k, a, b in spans if k in ("login", "secret", "iban")] == [
        "ftp://bob:pw@host.example", "abcdefghij0123456789", "GB82 WEST 1234 5698 7654 32"]
    assert pii.Finder().spans("see https://www.example.org/licenses for the iban rules; token: none") == []
    assert pii.redact("mail a@b.cd now", [("email", 5, 11)]) == "mail <EMAIL> now"
    got = queries.pii_digest(pii.find_personal_data(frame([*ODD, (9, "a@b.cd")]))).collect()
    assert [r.doc_id for r in got] == [i for i, _ in ODD] + [9]
    assert got[1].base_sha256 == hashlib.sha256(b"").hexdigest() and got[-1].spans == "email:0:6"
    assert pii.find_personal_data(frame([])).collect() == []


def brute_components(rows):
    sets, root = {}, {}
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.setdefault(i, []).append({tuple(words[k:k + 5]) for k in range(len(words) - 4)}
                                      if len(words) >= 5 else {tuple(words)} if words else set())
        root[i] = i

    def find(x):
        return x if root[x] == x else find(root[x])

    for a in sets:
        for b in sets:
            if a < b and any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b]):
                u, v = sorted((find(a), find(b)))
                root[v] = u
    return {i: find(i) for i in sets}, sets


@pytest.mark.parametrize("common", [1, 8])
def test_near_duplicates_equal_all_pairs(frame, common):
    rng = random.Random(common)
    rows = []
    for family in range(6):
        base = [f"w{rng.randint(0, 400)}" for _ in range(rng.randint(6, 160))]
        for _ in range(rng.randint(2, 12)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                copy[rng.randrange(len(copy))] = f"z{rng.randint(0, 9999)}"
            rows.append((len(rows) + 20, " ".join(copy)))
    line = " ".join(f"line{k}" for k in range(30))  # a passage many otherwise different texts share
    rows += [(300 + k, line + " " + " ".join(f"q{k}_{j}" for j in range(rng.randint(0, 40)))) for k in range(15)]
    rows = [*ODD[1:5], (9, "One"), (10, "A B c d e"), (11, "a b C d e"), *rows]
    want, sets = brute_components(rows)
    got = jaccard_join.near_duplicates(frame([(None, line), *rows]), common=common).collect()
    assert len(got) == len(rows) + 1
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert r.component_id == want[r.doc_id] and r.n_shingles == len(sets[r.doc_id][0])
    assert jaccard_join.near_duplicates(frame([])).collect() == []


def test_node_meets_members_of_a_group_once(spark, monkeypatch):
    """Ten near copies and a node share many prefix shingles: a row for each pair, not for each shingle."""
    kept = jaccard_join.stage(spark.createDataFrame(
        [(gram, d, 100, 0 if d < 10 else d, 0, 100 - gram, 16) for gram in range(20) for d in (*range(10), 50)],
        "gram bigint, doc_id bigint, n bigint, grp bigint, common int, rest bigint, cls int"), "kept")
    sketches = jaccard_join.stage(kept.select("doc_id", *(F.lit(0).cast("bigint").alias(k) for k in jaccard_join.SKETCH)).distinct(), "sk")
    meet = jaccard_join.stage(jaccard_join._group_pairs(kept, sketches), "meet")
    assert meet.count() >= 10
    made, near = [], jaccard_join._near_members
    monkeypatch.setattr(jaccard_join, "_near_members", lambda *a: (made.append(near(*a)), made[0])[1])
    pairs = jaccard_join._member_pairs(meet, kept, sketches)
    assert sorted(map(tuple, pairs.collect())) == [(50, d) for d in range(10)]
    assert made[0].count() == 10


def test_texts_of_one_form_do_not_meet_in_pairs(frame, monkeypatch):
    """Sixty texts share a form of which each changes an own part: too far apart to link, but their
    first shingles are common, and the next ones of the form stand among the first of none."""
    rng = random.Random(5)
    base = [f"w{k}" for k in range(150)]

    def changed(words, n, mark):
        return [f"{mark}{k}" if k in places else w for places in [set(rng.sample(range(150), n))] for k, w in enumerate(words)]

    texts = [changed(base, 9, f"d{k}_") for k in range(60)]
    texts += [changed(t, 2, "z") for t in texts[:4]]
    rows = [(k, " ".join(t)) for k, t in enumerate(texts)]
    counts, stage = {}, jaccard_join.stage

    def counted(df, name, **options):
        out = stage(df, name, **options)
        counts[name] = out.count()
        return out

    monkeypatch.setattr(jaccard_join, "stage", counted)
    want, _ = brute_components(rows)
    assert {r.doc_id: r.component_id for r in jaccard_join.near_duplicates(frame(rows)).collect()} == want
    assert len(set(want.values())) == 60
    assert counts["group-pairs"] < 600, counts


def test_near_duplicates_of_ids_with_several_texts(frame):
    rng = random.Random(12)

    def text(n=60):
        return [f"w{rng.randint(0, 10**6)}" for _ in range(n)]

    def near(words):
        return [*words[:-1], f"z{rng.randint(0, 10**6)}"]

    rows = []
    for k in range(0, 1000, 100):  # ten times, so that either text of 5 is the one with the smaller digest
        a, b = text(), text()
        rows += [(k + 3, a), (k + 5, a), (k + 5, b), (k + 9, b), (k + 11, near(b)), (k + 20, text())]
        c, d, e = text(), text(), text()  # near copies of each of three texts of one id
        rows += [(k + 30, c), (k + 30, d), (k + 30, e), (k + 31, near(c)), (k + 32, near(d)), (k + 33, near(e)), (k + 30, d)]
    rows = [(i, " ".join(w)) for i, w in rows] + [(40, ""), (40, "a b c d e f g"), (41, "a b c d e f g"), (40, None)]
    for top in (5000, 2**63 - 1):
        some = [*rows, (top, "one text of the last id"), (top, rows[2][1])]
        want, _ = brute_components(some)
        got = jaccard_join.near_duplicates(frame(some)).collect()
        assert len(got) == len(some)
        assert {(r.doc_id, r.component_id) for r in got} == {(i, want[i]) for i, _ in some}


def test_components_of_a_chain(spark):
    edges = [(k, k + 1) for k in range(50)] + [(70, 60), (60, 70), (80, 80)]
    got = dict(components.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect())
    assert got == {**{k: 0 for k in range(1, 51)}, 70: 60}


def test_packing_pieces_cover_every_token_once(frame):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    rng = random.Random(3)
    rows = [*ODD[:7], *((k, random_text(rng, rng.choice([3, 60, 900]))) for k in range(10, 40))]
    got = packing.pack(frame(rows).coalesce(1), packing.read_ranks(queries.RANKS), public_tokenizers.PATTERN,
                       strip_tokens=20_000).collect()
    at, sequences = iter(got), {}
    for doc_id, text in rows:
        ids, start = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], 0
        while start < len(ids):
            r = next(at)
            piece = np.array(ids[start:start + r.length], "<u4")
            assert (r.doc_id, r.start, r.doc_tokens, r.ids_crc32) == (doc_id, start, len(ids), zlib.crc32(piece.tobytes()))
            assert r.offset == sequences.get(r.sequence_id, 0)
            sequences[r.sequence_id] = r.offset + r.length
            start += r.length
    assert next(at, None) is None and max(sequences.values()) <= 1024
    padding = sum(1024 - n for n in sequences.values() if n & (n - 1))
    assert padding < 0.03 * sum(sequences.values())


def test_packing_windows_are_optimal():
    rng = np.random.default_rng(4)
    size = 64
    exact = {size >> k for k in range(5)}
    pad = lambda n: 0 if n in exact else size - n
    for _ in range(100):
        cuts = np.concatenate([[0], np.cumsum(rng.integers(1, 40, rng.integers(1, 40)))])
        cost = rng.integers(0, 20, len(cuts)).astype(float)
        best = [0.0]
        for i in range(1, len(cuts)):
            best.append(cost[i] + min(best[j] + pad(cuts[i] - cuts[j]) for j in range(i) if cuts[i] - cuts[j] <= size))
        path = [0, *packing.windows(cuts, cost, size)]
        assert sum(pad(cuts[b] - cuts[a]) + cost[b] for a, b in zip(path, path[1:])) == best[-1]


def test_toxicity_on_held_out_rows(spark, frame):
    data = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "labels"))
    halves = labels.withColumn("half", F.pmod(F.xxhash64("doc_id"), F.lit(2)))
    model = toxicity.train(docs, halves.where("half = 0").select("doc_id", F.col("toxic").alias("grade")))
    assert model.thresholds == sorted(model.thresholds) and len(model.thresholds) >= 2
    scored = toxicity.score_severity(docs, model).withColumnRenamed("toxic", "said")
    n = {(r.toxic, r.said): r["count"] for r in scored.join(halves.where("half = 1"), "doc_id").groupBy("toxic", "said").count().collect()}
    assert n[1, True] > 0.75 * (n[1, True] + n[1, False])
    assert n.get((0, True), 0) < 0.02 * n[0, False]
    got = toxicity.score_severity(frame(ODD), model).collect()
    assert [r.doc_id for r in got] == [i for i, _ in ODD] and not any(r.toxic for r in got[:4])
    assert toxicity.score_severity(frame([]), model).collect() == []
    assert toxicity.train(docs, labels.where("false").select("doc_id", F.col("toxic").alias("grade"))).weights == {}


def brute_kept(rows):
    seen, out = {}, {}
    for i, text in sorted(rows):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - 99):
            if seen.setdefault(data[s:s + 100], (i, s)) != (i, s):
                gone[s:s + 100] = b"\1" * 100
        out[i] = bytes(c for c, g in zip(data, gone) if not g)
    return out


def test_repeats_equal_brute_force(frame):
    rng = random.Random(5)
    passages = [random_text(rng, rng.choice([15, 30, 60, 200])) for _ in range(12)]
    rows = [(k, "".join(rng.choice([rng.choice(passages), random_text(rng, 12)]) for _ in range(rng.randint(1, 6))))
            for k in range(20, 80)]
    rows += [(1, None), (2, ""), (6, "word " * 700), (7, "x" * 5_000), (8, "é" * 300), (9, "ab" * 49 + "c"), (90, "ab" * 49 + "c")]
    want = brute_kept(rows)
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(frame(rows)).collect()}
    assert {i: bytes(r.kept) for i, r in got.items()} == want
    assert got[1].n_bytes == 0 and got[7].spans[0].start == 1
    odd = suffix_dedup.remove_repeats(frame([(5, "p" * 120), (5, "p" * 120), (None, "q r" * 60), (4, "q r" * 60)])).collect()
    kept = {r.doc_id: len(r.kept) for r in odd}
    assert len(odd) == 4 and kept == {5: 1, 4: 3, None: 0}
    assert suffix_dedup.remove_repeats(frame([])).collect() == []


def test_merge_of_front_coded_runs():
    rng = random.Random(6)
    runs = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 8))) for _ in range(rng.randint(0, 40)))
            for _ in range(7)]

    def coded(run):
        for k, s in enumerate(run):
            yield s, suffix_dedup._shared_from(run[k - 1], s, 0) if k else 0, 0, 0, 0, 0

    out = list(suffix_dedup.merge_runs([coded(r) for r in runs]))
    assert [e[0] for e, _ in out] == sorted(s for r in runs for s in r)
    for (a, _), (b, h) in zip(out, out[1:]):
        assert h == suffix_dedup._shared_from(a[0], b[0], 0)


def test_main_text(spark):
    page = """<html><head><title>no</title><script>var a = "<p>";</script></head><body class="page">
    <header><p>site header</p></header><nav><ul><li><a href=1>x</a></ul></nav><div class="cookie-notice"><p>We use cookies</p></div>
    <div id="content"><h1>A  title</h1><div><p>First &amp; <b>bold</b> text,<br>with more of it.<p>Second one has
    a <a href="y">link</a> in it.</div><div class="comments"><p>reader comment text</p></div></div>
    <aside><p>side</p></aside><form><p>sign up</p></form><footer>&copy; me</footer></body>"""
    assert html_text.main_text(page) == "A title\n\nFirst & bold text, with more of it.\n\nSecond one has a link in it."
    assert [html_text.main_text(x) for x in (None, "", "plain  text", "<p>a<p>b", "<script>x", "<b")] == [
        "", "", "plain text", "a\n\nb", "", "<b"]
    rows = [(1, "u", None, 1), (None, None, "<p>x" * 20_000, 1), (1, "u", "<article><p>q</article>", 1), (1, "u", "<article><p>q</article>", 1)]
    got = html_text.extract_main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string, text int")).collect()
    assert [r.n_chars for r in got] == [0, 20_000 + 2 * 19_999, 1, 1]


def test_main_text_by_density_with_and_without_articles():
    long = [f"This is sentence number {k} of the story, which has a good many words and no links at all in it." for k in range(8)]
    paragraphs = ["<p>" + s + "</p>" for s in long]
    menu = "<ul>" + "".join(f"<li><a href={k}>entry {k}</a></li>" for k in range(9)) + "</ul>"
    whole = "\n\n".join(long)
    body = "".join(paragraphs)
    half, rest = "".join(paragraphs[:4]), "".join(paragraphs[4:])
    # no article
    assert html_text.main_text(f"<body>{menu}<div id=content>{body}</div>{menu}</body>") == whole
    # a teaser in an article of its own, before or after the text
    teaser = "<article><a href=x>Read more</a> <a href=y>here</a></article>"
    assert html_text.main_text(f"<body>{teaser}<div id=content>{body}</div></body>") == whole
    assert html_text.main_text(f"<body><div id=content>{body}</div>{teaser}</body>") == whole
    # several parts, and a title beside the article
    assert html_text.main_text(f"<body>{menu}<article>{half}</article><article>{rest}</article></body>") == whole
    assert html_text.main_text(f"<body><main><h1>Title</h1><article>{half}</article><article>{rest}</article></main></body>") == "Title\n\n" + whole
    assert html_text.main_text(f"<body><main><h1>Title</h1><article>{body}</article></main>{menu}</body>") == "Title\n\n" + whole
    # the threshold holds inside an article too
    links = "<div>" + "".join(f"<span><a href={k}>x{k}</a></span>" for k in range(2)) + "</div>"
    assert html_text.main_text(f"<body><article><div>{body}</div>{links}</article></body>") == whole


def test_main_text_keeps_text_whose_class_only_mentions_other_parts():
    long = [f"This is sentence number {k} of the story, which has a good many words and no links at all in it." for k in range(8)]
    body, whole = "".join("<p>" + s + "</p>" for s in long), "\n\n".join(long)
    for name in ("content has-sidebar", "no-comments", "sidebar", "page with-footer"):  # the last but one holds all text
        assert html_text.main_text(f'<body><div class="{name}">{body}</div></body>') == whole, name
    for name in ("sidebar", "left sidebar-wide", "site-footer", "ad-slot", "Cookie_Notice", "comments"):
        assert html_text.main_text(f'<body><div>{body}</div><div class="{name}"><p>Something else that is said at length.</p></div></body>') == whole
    title = '<div class="entry-header"><h1>The title</h1></div>'
    assert html_text.main_text(f"<body><article>{title}{body}</article></body>") == "The title\n\n" + whole
    # more comments than text, beside an article
    comments = '<div class="comments">' + body * 5 + "</div>"
    assert html_text.main_text(f"<body><article>{body}</article>{comments}</body>") == whole
    # a list of sources at the end of an article stays, a menu outside one does not
    sources = "<ul>" + "".join(f"<li><a href={k}>a source of number {k}</a></li>" for k in range(5)) + "</ul>"
    listed = whole + "".join(f"\n\na source of number {k}" for k in range(5))
    assert html_text.main_text(f"<body><article>{body}{sources}</article></body>") == listed
    assert html_text.main_text(f"<body><div>{body}</div>{sources}</body>") == whole


def test_main_text_time_follows_the_length_at_any_depth():
    def seconds(n):
        source = "<div><span>" * n + "some text" + "</section></i>" * n + "<p>" * n + "x" * 50
        began = time.process_time()
        assert "some text" in html_text.main_text(source)
        return time.process_time() - began

    seconds(1_000)
    assert seconds(50_000) < 40 * max(seconds(5_000), 0.05)


def test_main_text_of_the_given_pages(spark):
    for page in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect():
        body = page.html.split("<article>")[1].split("</article>")[0]
        blocks = (" ".join(__import__("html").unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split(r"<p>|</p>|</?h\d>", body))
        assert html_text.main_text(page.html) == "\n\n".join(b for b in blocks if b)


def test_nearest_recall_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(7)
    x = rng.standard_normal((3000, 16)).round(3)
    x[100:400] = x[50]  # many equal vectors
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    odd = [(5000, None), (5050, [0.0] * 16), (5100, [float("nan")] * 16), (5150, [None] + [1.0] * 15), (5200, [1.0]), (None, [1.0] * 16)]
    base = spark.createDataFrame(rows + odd, "id bigint, vector array<double>")
    got = rp_forest.nearest(base, base.where("id % 50 = 0")).collect()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    found, hits = {}, 0
    for r in got:
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id))
        assert abs(r.score - unit[r.query_id] @ unit[r.vec_id]) < 1e-12
    assert sorted(found) == list(range(0, 3000, 50))
    for q, near in found.items():
        scores = (unit * unit[q]).sum(axis=1).round(12)
        scores[q] = -9
        best = np.lexsort((np.arange(3000), -scores))[:5].tolist()
        assert [rank for rank, _ in sorted(near)] == [1, 2, 3, 4, 5]
        hits += len({v for _, v in near} & set(best))
    assert hits >= 0.9 * 5 * len(found)
    assert sorted(found[50]) == [(k + 1, 100 + k) for k in range(5)]
    assert rp_forest.nearest(base.where("false"), base).collect() == []


def _recall(spark, x):
    """Share of the five nearest by brute force that the production defaults find."""
    base = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "id bigint, vector array<double>")
    got = rp_forest.nearest(base, base.where("id % 50 = 0")).collect()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    found = {}
    for r in got:
        found.setdefault(r.query_id, set()).add(r.vec_id)
        assert abs(r.score - unit[r.query_id] @ unit[r.vec_id]) < 1e-12
    assert sorted(found) == list(range(0, len(x), 50))
    hits = 0
    for q, near in found.items():
        scores = unit @ unit[q]
        scores[q] = -9
        hits += len(near & set(np.argsort(-scores)[:5].tolist()))
    return hits / (5 * len(found))


@pytest.mark.parametrize("n", [500, 2_000, 12_000, 50_000])
@pytest.mark.parametrize("clustered", [False, True])
def test_nearest_recall_at_the_defaults(spark, n, clustered):
    rng = np.random.default_rng(11)
    x = rng.standard_normal((n, 24))
    if clustered:
        x = 0.3 * x + rng.standard_normal((40, 24))[rng.integers(0, 40, n)]
    recall = _recall(spark, x)
    print("recall", n, clustered, recall)
    assert recall >= 0.9


def test_nearest_of_the_given_vectors(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").orderBy("vec_id").select("embedding").collect()
    recall = _recall(spark, np.array([r[0] for r in rows], np.float64))
    print("recall", recall)
    assert recall >= 0.9


def test_nearest_of_huge_tiny_and_few_vectors(spark):
    rows = [(0, [1e200, 0.0]), (1, [1e200, 1e200]), (2, [1e-200, 0.0]), (3, [5e-324, 0.0]), (4, [-1.0, 0.0])]
    base = spark.createDataFrame(rows, "id bigint, vector array<double>")
    got = [(r["rank"], r.vec_id, round(r.score, 12)) for r in
           rp_forest.nearest(base, base.where("id = 0")).orderBy("rank").collect()]
    assert got == [(1, 2, 1.0), (2, 3, 1.0), (3, 1, round(0.5 ** 0.5, 12)), (4, 4, -1.0)]


def test_lattice_equals_viterbi_and_decodes(spark, frame):
    model = piece_lattice.read_model(queries.PIECES)
    pieces = {m[0]: (m[1], m[2]) for m in model if m[4] is None}
    spelt = {m[4]: m[1] for m in model if m[4] is not None}
    unknown = min(s for _, s in pieces.values() if s > -1e8) + piece_lattice.UNKNOWN

    def viterbi(word):
        best = [(0.0, 0, [])]
        for i in range(1, len(word) + 1):
            options = []
            for j in range(max(0, i - 16), i):
                if word[j:i] in pieces:
                    options.append((best[j][0] + pieces[word[j:i]][1], -j, [pieces[word[j:i]][0]]))
                elif i - j == 1:
                    options.append((best[j][0] + unknown, -j, [spelt[b] for b in word[j:i].encode()]))
            best.append(max(options))
        ids, i = [], len(word)
        while i:
            ids, i = best[i][2] + ids, -best[i][1]
        return ids

    rng = random.Random(8)
    rows = [*ODD[:6], (7, "x" * 150), (8, "\U0001F9FF naïve"), *((k, random_text(rng, 30)) for k in range(10, 20))]
    docs, words = piece_lattice.encode_documents(frame(rows), model, frequent=5)
    coded = {r.word: r.ids for r in words.collect()}
    assert coded and all(viterbi(w) == ids for w, ids in coded.items())
    assert all(r.text.replace(" ", "▁") == r.word for r in piece_lattice.decode(words, model).collect())
    got = docs.collect()
    for (doc_id, text), r in zip(rows, sorted(got, key=lambda r: [i for i, _ in rows].index(r.doc_id))):
        parts = ["▁" + w for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
        assert (r.n_words, r.n_tokens) == (len(parts), sum(len(coded[p]) for p in parts))
    assert piece_lattice.encode_documents(frame([]), model)[0].collect() == []


def test_lattice_gives_and_decodes_the_ids_of_each_document(spark, frame):
    model = piece_lattice.read_model(queries.PIECES)
    rng = random.Random(9)
    rows = [(None, "no id here"), (1, None), (2, ""), (3, " \n"), (4, "one"), (5, "\U0001F9FF naïve"), (6, "word " * 3000),
            *((k, random_text(rng, 50)) for k in range(10, 30))]
    for frequent in (0, 5, 1000):
        docs, words = piece_lattice.encode_documents(frame(rows), model, frequent=frequent)
        coded = {r.word: r.ids for r in words.collect()}
        got = {r.doc_id: r for r in piece_lattice.decode(docs, model).collect()}
        for doc_id, text in rows:
            parts = ["▁" + w for w in (text or "").split()]
            r = got[doc_id]
            assert (r.n_words, r.n_tokens, r.ids) == (len(parts), len(r.ids), [i for p in parts for i in coded[p]])
            assert r.text == "".join(parts).replace("▁", " ")
    odd = spark.createDataFrame([(None,), ([-1],), ([10**6],), ([],)], "ids array<int>")
    assert [r.text for r in piece_lattice.decode(odd, model).collect()] == [None, None, None, ""]


def test_lattice_holds_few_documents_at_a_time(spark, frame, monkeypatch):
    """Documents are dealt into parts by their number, and texts come in small batches."""
    monkeypatch.setattr(piece_lattice, "PART_DOCS", 4)
    docs, _ = piece_lattice.encode_documents(
        frame([(k, f"some words of a text and q{k}") for k in range(40)]), piece_lattice.read_model(queries.PIECES), frequent=3)
    parts = docs.groupBy(F.spark_partition_id().alias("part")).count().collect()
    assert sum(r["count"] for r in parts) == 40 and len(parts) >= 5
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    with piece_lattice._small_batches(spark):
        sizes = spark.range(3000, numPartitions=1).mapInArrow(
            lambda batches: (b.slice(0, 1) for b in batches), "id bigint").count()
    assert sizes == 3000 // piece_lattice.BATCH_DOCS and spark.conf.get(name) == before
    batches = spark.createDataFrame([("a b",), ("b c",)], "text string").toArrow().to_batches(1)
    counted = list(piece_lattice._count_words(iter([b for x in batches for b in (x.slice(0, 1), x.slice(0, 1))])))
    assert len(counted) == 1


def test_lattice_shuffles_words_of_parts_but_no_occurrences(frame, monkeypatch):
    """Parts of documents are read where they are; each word of a part comes back once. Words and
    documents are whole however small the parts and buckets are."""
    model = piece_lattice.read_model(queries.PIECES)
    rng = random.Random(11)
    rows = [(k % 20, random_text(rng, 40)) for k in range(40)] + [(None, None), (50, "again " * 2000), (51, "")]
    results = []
    for docs, distinct, buckets, frequent in ((4000, 10**6, 10**6, 10), (3, 5, 7, 10), (7, 10**6, 3, 0), (7, 50, 20, 10**6)):
        monkeypatch.setattr(piece_lattice, "PART_DOCS", docs)
        monkeypatch.setattr(piece_lattice, "PART_DISTINCT", distinct)
        monkeypatch.setattr(piece_lattice, "BUCKET_WORDS", buckets)
        found, words = piece_lattice.encode_documents(frame(rows), model, frequent=frequent)
        assert found._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
        results.append((sorted(map(str, found.collect())), sorted(map(str, words.collect()))))
    assert all(r == results[0] for r in results) and len(results[0][0]) == len(rows)
    counts = Counter("▁" + w for _, text in rows for w in re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    assert {r.word: r.n for r in words.collect()} == counts


def test_lattice_query_decodes_the_whole_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    got = queries.QUERIES["op9_piece_lattice"](spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(texts)
    for r in got:
        spelt = b"".join(b" " + w for w in (texts[r.doc_id] or "").encode().split())
        assert r.text_sha256 == hashlib.sha256(spelt).hexdigest()


def test_lattice_of_long_words_equals_viterbi_over_the_whole_word(frame):
    model = piece_lattice.read_model(queries.PIECES)
    pieces = {m[0]: (m[1], m[2]) for m in model if m[4] is None}
    spelt = {m[4]: m[1] for m in model if m[4] is not None}
    unknown = min(s for _, s in pieces.values() if s > -1e8) + piece_lattice.UNKNOWN

    def viterbi(word):
        best = [(0.0, 0, [])]
        for i in range(1, len(word) + 1):
            best.append(max(
                (best[j][0] + (pieces[word[j:i]][1] if word[j:i] in pieces else unknown), -j,
                 [pieces[word[j:i]][0]] if word[j:i] in pieces else [spelt[b] for b in word[j:i].encode()])
                for j in range(max(0, i - 20), i) if word[j:i] in pieces or j == i - 1))
        ids, i = [], len(word)
        while i:
            ids, i = best[i][2] + ids, -best[i][1]
        return ids

    rng = random.Random(10)
    letters = "theandingationé\U0001F9FFß漢字/=-"
    texts = ["".join(rng.choice(letters) for _ in range(n)) for n in (62, 63, 64, 65, 127, 128, 500, 4000)]
    texts += ["https://example.com/" + "information" * 300, "x" * 150, "international" * 5 + " " + "international" * 50]
    assert max(len(m[0]) for m in model if m[4] is None) <= 20
    docs, words = piece_lattice.encode_documents(frame(list(enumerate(texts))), model, frequent=3)
    coded = {r.word: r.ids for r in words.collect()}
    assert coded == {"▁" + w: viterbi("▁" + w) for text in texts for w in text.split()}
    for r in piece_lattice.decode(docs, model).collect():
        parts = texts[r.doc_id].split()
        assert (r.n_words, r.ids) == (len(parts), [i for w in parts for i in coded["▁" + w]])
        assert r.text == "".join(" " + w for w in parts)
    short = [w for w in ("▁" + w for t in texts for w in random_text(rng, 30).split())]
    known = {r.word: r.ids for r in piece_lattice.encode_documents(frame([(1, " ".join(w[1:] for w in short))]), model)[1].collect()}
    assert all(piece_lattice.best_path(w, pieces, 20, unknown, spelt) == known[w] for w in short)
    assert piece_lattice.encode_documents(frame([]), model)[0].collect() == []


def test_exact_dedup_and_index(spark, frame):
    rows = [*ODD, (20, "a  b\tc d e f g"), (19, "a b c d e f g "), (None, "one")]
    index = digest_index.DigestIndex(spark, buckets=4)
    got = digest_index.exact_dedup(frame(rows), index).collect()
    groups = {}
    for i, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(i)
    assert len(got) == len(rows) and sum(r.kept for r in got) == len(groups)
    for r in got:
        text, ids = next((t, g) for t, g in groups.items() if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256)
        assert r.group_size == len(ids) and r.keep_id == min((i for i in ids if i is not None), default=None)
    again = digest_index.exact_dedup(frame([(0, "one"), (0, "new text")]), digest_index.DigestIndex(spark, index.path, 4))
    assert sorted((r.keep_id, r.kept, r.group_size) for r in again.collect()) == [(0, True, 1), (4, False, 4)]
    assert digest_index.exact_dedup(frame([])).collect() == []


def test_index_counts_over_batches_reruns_and_buckets(spark, frame):
    index = digest_index.DigestIndex(spark, buckets=8)
    sizes = []
    for name, ids in (("a", [5, 3]), ("b", [1, 2, 9]), ("c", [7])):
        for _ in range(2):  # each batch is run twice
            got = digest_index.exact_dedup(frame([(i, "same  text") for i in ids] + [(100, f"only {name}")]), index, name).collect()
            sizes.append({r.group_size for r in got if r.doc_id != 100})
            assert {r.keep_id for r in got if r.doc_id != 100} == {3}
            assert [r.doc_id for r in got if r.kept and r.doc_id != 100] == ([3] if name == "a" else [])
            assert [r.kept for r in got if r.doc_id == 100] == [True]
    assert sizes == [{2}, {2}, {5}, {5}, {6}, {6}]
    assert index.table().count() == 6
    with pytest.raises(ValueError, match="8 buckets"):
        digest_index.DigestIndex(spark, index.path, 3)
    again = digest_index.exact_dedup(frame([(0, "same text")]), digest_index.DigestIndex(spark, index.path)).collect()
    assert [(r.keep_id, r.kept, r.group_size) for r in again] == [(3, False, 7)]
    tables = {t.name for t in spark.catalog.listTables()}
    digest_index.exact_dedup(frame([(1, "x")])).collect()
    assert {t.name for t in spark.catalog.listTables()} == tables
