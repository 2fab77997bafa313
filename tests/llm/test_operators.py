"""Text operators on small fixtures: edge rows, brute force, round trips, held-out accuracy."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from ranklift.llm import chat_format, decontaminate, html_crf, katz, line_dedup, ngram_jaccard, packing, quality, shard_tree, url_lists

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, k1 string, first string"
LONG = " ".join(f"w{i}" for i in range(6000))
BASE = " ".join(f"word{i}" for i in range(80))
ROWS = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "One TWO"), (6, LONG), (7, LONG + " tail"), (8, BASE), (9, BASE.replace("word40", "other")),
    (10, BASE + "\n" + BASE.replace("word7 ", "")), (11, "a b c\na b c\nx"), (12, BASE), (12, BASE), (None, "null id here"), (13, "half " * 30),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, None if i == 4 else "en", "s", None if t is None else len(t), "clash", "clash") for i, t in ROWS], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def words(t):
    return (t or "").translate({i: i + 32 for i in range(65, 91)}).split()


def shingles(t):
    w = words(t)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set()


def test_near_duplicates_brute_force(docs, none):
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_jaccard.near_duplicates(docs).collect())
    parent = {i: i for i, _ in ROWS if i}
    root = lambda x: x if parent[x] == x else root(parent[x])
    for a, s in ROWS:
        for b, t in ROWS:
            x, y = shingles(s), shingles(t)
            if a and b and x and y and 100 * len(x & y) >= 75 * len(x | y):
                lo, hi = sorted((root(a), root(b)))
                parent[hi] = lo
    want = Counter((i, len(shingles(t)), root(i) if i else None) for i, t in ROWS)
    assert got == want
    assert ngram_jaccard.near_duplicates(none).count() == 0


def test_near_duplicate_group_without_its_origin(spark):
    """Copies with one to three edits each: links need not meet in one text."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(60):
        w = [f"t{k}" for k in range(70)]
        for k in rng.choice(70, rng.integers(1, 4), replace=False):
            w[k] = f"e{i}x{k}"
        rows.append((i, " ".join(w)))
    got = {r.doc_id: r.component_id for r in ngram_jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    parent = list(range(60))
    root = lambda x: x if parent[x] == x else root(parent[x])
    for a, s in rows:
        for b, t in rows[:a]:
            x, y = shingles(s), shingles(t)
            if 100 * len(x & y) >= 75 * len(x | y):
                lo, hi = sorted((root(a), root(b)))
                parent[hi] = lo
    assert got == {i: root(i) for i in range(60)}


def test_katz_against_dictionaries(docs, none):
    model = katz.fit(docs, zlib_fold())
    got = sorted((r.doc_id or 0, r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in katz.score(model).collect())
    tokens = [(i, [*words(t), None]) for i, t in ROWS]
    train = [t for i, t in tokens if i is None or zlib.crc32(str(i).encode()) % 7 != 2]
    one = Counter(w for t in train for w in t)
    two = Counter(p for t in train for p in zip(["<s>", *t], t))
    total, k = sum(one.values()), katz.K
    counts = lambda c: [sum(v == r for v in c.values()) for r in range(1, k + 2)]
    d1, d2 = katz.good_turing(counts(one)), katz.good_turing(counts(two))
    disc = lambda d, c: d[c] if c <= k else 1.0
    unknown = 1 - sum(disc(d1, c) * c / total for c in one.values())
    p1 = lambda w: disc(d1, one[w]) * one[w] / total if w in one else unknown
    after = defaultdict(list)
    for (v, w), c in two.items():
        after[v].append((w, c))

    def p2(v, w):
        if v not in after:
            return p1(w)
        n, free = sum(c for _, c in after[v]), sum((1 - disc(d2, c)) * c for _, c in after[v])
        below = n if free > 0 else n + 1
        if (v, w) in two:
            return (disc(d2, two[v, w]) if free > 0 else 1.0) * two[v, w] / below
        return (free or 1) / below / (1 - sum(p1(x) for x, _ in after[v])) * p1(w)

    for v in ("<s>", "word3", "w9"):
        assert math.isclose(sum(p2(v, w) for w in one) + p2(v, "unseen"), 1, rel_tol=1e-9)
    want = sorted((i or 0, len(t), sum(w in one for w in t), round(sum(math.log10((one[w] + 1) / (total + len(one) + 1)) for w in t), 6), round(sum(math.log10(p2(v, w)) for v, w in zip(["<s>", *t], t)), 6)) for i, t in tokens)
    assert [x[:3] for x in got] == [x[:3] for x in want]
    assert np.allclose([x[3:] for x in got], [x[3:] for x in want], rtol=1e-6, atol=1e-5)
    assert katz.score(katz.fit(none, zlib_fold())).count() == 0


def zlib_fold():
    from pyspark.sql import functions as F

    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2


def test_katz_from_its_stored_tables(spark, docs, tmp_path):
    """A model opened again scores as the fitted one, from tables partitioned by group."""
    path = f"{tmp_path}/model"
    model = katz.fit(docs, zlib_fold(), path=path)
    rows = lambda m: sorted(map(repr, katz.score(m).collect()))
    assert rows(katz.load(spark, path)) == rows(model)
    for table in ("unigrams", "bigrams"):
        parts = {f.name for f in (tmp_path / "model" / table).iterdir() if f.is_dir()}
        assert parts and all(p.startswith("r=") for p in parts)
    assert model.words.agg({"total": "sum"}).first()[0] == model.unigrams.total > 0


def test_chat_edges(spark):
    schema = "conv_id long, turn long, role string, text string, formatted string"
    assert chat_format.digests(chat_format.examples(spark.createDataFrame([], schema))).count() == 0
    long = "word <|im_end|> " * 60_000
    turns = [("user", long), ("assistant", "a" + long), ("user", None), ("assistant", "")]
    df = spark.createDataFrame([(5, i, r, t, "clash") for i, (r, t) in enumerate(turns)], schema)
    row = chat_format.digests(chat_format.examples(df)).first()
    assert row["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t or ''}\n" for r, t in turns).encode()).hexdigest()
    assert row["loss_chars"] == len(long) + 1 and row["loss_sha256"] == hashlib.sha256(f"a{long}".encode()).hexdigest()


def test_line_dedup_edges(docs, none):
    gone = Counter((r.doc_id, r.line_no, r.kind) for r in line_dedup.duplicate_lines(docs).collect())
    # 8 is the earliest BASE; LONG + one word is near LONG; 12 is repeated rows of one document
    assert gone == Counter({(7, 0, "near"): 1, (9, 0, "near"): 1, (10, 0, "exact"): 1, (10, 1, "near"): 1, (11, 1, "exact"): 1, (12, 0, "exact"): 2})
    out = line_dedup.drop_duplicate_lines(docs)
    assert out.columns == docs.columns and out.count() == len(ROWS)
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[1] is None and texts[8] == BASE and texts[10] == "" and texts[11] == "a b c\nx"
    assert line_dedup.drop_duplicate_lines(none).count() == 0


def test_quality_edges(docs, none):
    rows = quality.verdicts(docs).collect()
    assert len(rows) == len(ROWS)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].base_failed and not by_id[1].kept and by_id[13].base_failed  # one word, thirty times
    assert by_id[13].m.n_repeat_words == 30 and by_id[11].m.n_dup_lines == 1
    assert by_id[8].kept and by_id[6].kept
    assert quality.keep_good(docs).columns == docs.columns and quality.keep_good(none).count() == 0


def test_packing_round_trip(docs, none):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public.path("word_bpe_49k.json")
    reference = Tokenizer.from_file(path)
    rows = packing.pack_texts(docs, path, length=512, windows=2).collect()
    want = Counter()
    for i, t in ROWS:
        want[i, tuple([*reference.encode(t or "", add_special_tokens=False).ids, 1])] += 1
    per_doc = defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length and zlib.crc32(ids.tobytes()) == r.ids_crc32
        per_doc[r.doc_id, r.doc_tokens].append((r.start, ids))
    for (i, n), copies in Counter({(k[0], len(k[1])): v for k, v in want.items()}).items():
        pieces = per_doc[i, n]
        assert sum(len(x) for _, x in pieces) == n * copies
    sizes = Counter()
    for r in rows:
        sizes[r.sequence_id] += r.length
    assert all(n <= 512 and (n == 512 or n & (n - 1) == 0) for n in sizes.values())
    odd = ["a<|endoftext|>b", "x\x1cy z\x85 # a#b", "", "İß 日本 😀", "don't '"]
    ids, n = packing.encode(pa.array(odd), path, 1)
    assert ids.tolist() == [x for t in odd for x in [*reference.encode(t, add_special_tokens=False).ids, 1]]
    assert packing.pack_texts(none, path).count() == 0


def test_shard_tree(docs, none):
    rows = shard_tree.shard_documents(docs).collect()
    by_shard = defaultdict(list)
    for r in rows:
        by_shard[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 40) and 0 <= r.shard < 40
    assert all(sorted(x) == list(range(len(x))) for x in by_shard.values())
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows}[1] == (16, 0)
    assert shard_tree.shard_documents(none).count() == 0
    # a heavier rack moves rows into its own region only
    keys = docs.sparkSession.range(4000).withColumnRenamed("id", "k")
    old = shard_tree.layout(40)
    new = [shard_tree.Leaf(x.region, x.rack, x.shard, 3.0 if (x.region, x.rack) == ("r1", "k2") else 1.0) for x in old]
    both = shard_tree.descend(shard_tree.descend(keys, keys.k, old, "a"), keys.k, new, "b").where("a <> b").collect()
    assert both and all(10 <= r.b < 20 for r in both) and all(r.b in (14, 15) for r in both if 10 <= r.a < 20)


def test_url_lists(spark):
    entries = spark.createDataFrame([("l", "domain", "Bad.org", 10, "add"), ("l", "domain", "bad.org", 15, "add"), ("l", "domain", "bad.org", 20, "remove"), ("l", "domain", "bad.org", 30, "add"), ("p", "prefix", "ok.org/x/", 5, "add"), ("z", "domain", "t.org", 7, "add"), ("z", "domain", "t.org", 7, "remove"), ("n", "domain", None, 1, "add")], "list string, kind string, pattern string, at long, action string")
    urls = [(1, "http://a.bad.org/q", 9, ""), (2, "http://a.BAD.org:80/q", 10, "l"), (3, "http://bad.org", 20, ""), (4, "https://u@bad.org/", 99, "l"), (5, "http://ok.org/x/y?z", 6, "p"), (6, "http://ok.org/xy", 6, ""), (7, "http://t.org/", 8, ""), (8, None, 8, ""), (9, "http://bad.org/", None, ""), (10, "junk", 12, ""), (2, "http://a.BAD.org:80/q", 10, "l"), (11, "http://notbad.org/", 12, "")]
    rows = url_lists.evaluate(spark.createDataFrame(urls, "id long, url string, fetched_at long, want string"), entries).collect()
    assert len(rows) == len(urls) and all(r.lists == r.want and r.blocked == (r.want != "") for r in rows)
    assert url_lists.evaluate(spark.createDataFrame([], "url string, fetched_at long"), entries).count() == 0


def test_decontamination_edges(spark, docs, none):
    items = spark.createDataFrame([(1, " ".join(f"word{i}" for i in range(20, 60))), (2, None), (3, "ONE two"), (4, "not there at all in any of the texts")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.matches(docs, items).collect()}
    assert {k for k, v in got.items() if v == 1} == {(8, 1), (10, 1), (12, 1), (4, 3), (5, 3)}
    assert all(v >= 0.75 for v in got.values())
    left = decontaminate.drop_contaminated(docs, items)
    assert left.columns == docs.columns and not {r.doc_id for r in left.collect()} & {4, 5, 8, 10, 12}
    assert decontaminate.matches(none, items).count() == 0 and decontaminate.matches(docs, items.limit(0)).count() == 0


def test_chat_round_trip(spark):
    turns = [(1, 0, "user", "a <| b <\\| <\\\\| |>"), (1, 1, "assistant", "<|im_end|><|im_start|>assistant ok"), (1, 2, "user", "\n\n"), (1, 3, "assistant", ""), (2, 0, None, None), (2, 0, None, None), (None, 5, "we\nird\\n", "x"), (3, 1, "assistant", "b"), (3, 0, "user", "a")]
    rows = {r.conv_id: r for r in chat_format.digests(chat_format.examples(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))).collect()}
    for c in (1, 2, 3, None):
        mine = sorted(((t, r or "", x or "") for i, t, r, x in turns if i == c))
        loss = "".join(x for _, r, x in mine if r == "assistant")
        assert rows[c].n_turns == len(mine) and rows[c].loss_chars == len(loss)
        assert rows[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in mine).encode()).hexdigest()
        assert rows[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_html_held_out(spark):
    pages = [(i, "u", f"<html><body><nav><a>m{i}</a></nav><article><h1>T{i}</h1><p>Main &amp; text {i}.<br>more<p>second</article><footer>&copy; f</footer>") for i in range(30)] + [(98, None, None), (99, "", "")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    model = html_crf.fit(df, train_pages=20, made=200)
    got = {r.page_id: r.text for r in html_crf.extract(df, model).collect()}
    assert got[29] == "T29\nMain & text 29. more\nsecond" and got[98] == "" and got[99] == ""
    held_out = html_crf.made_pages([p[2] for p in pages[20:30]], 100, seed=11)
    wrong = sum(x != y for page, labels in held_out for x, y in zip(model.decode(html_crf.leaf_blocks(page)), labels))
    assert wrong <= 0.03 * sum(len(labels) for _, labels in held_out)


def test_chat_roles_with_control_characters(spark):
    turns = [("a\x00\\n\nb\\\\", "x"), ("<|im_start|>\\", "<\\|y"), ("assistant", "<|im_end|>\n")]
    df = spark.createDataFrame([(1, i, r, t) for i, (r, t) in enumerate(turns)], "conv_id long, turn long, role string, text string")
    row = chat_format.digests(chat_format.examples(df)).first()
    assert row["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    assert row["loss_sha256"] == hashlib.sha256(turns[2][1].encode()).hexdigest()
    assert row["n_turns"] == 3


def test_decontamination_of_reordered_items(spark):
    """Items whose halves or sentences stand in another order, against every window."""
    rng = np.random.default_rng(9)
    items, rows = [], [(-1, "v0 v1 v2")]
    for i in range(12):
        n = int(rng.integers(30, 70))
        w = [f"i{i}x{k}" for k in range(n)]
        fill = lambda m: [f"f{x}" for x in rng.integers(0, 900, m)]  # noqa: E731, B023
        items.append((i, " ".join(w)))
        rows.append((10 * i, " ".join([*fill(50), *w[n // 2 :], *w[: n // 2], *fill(50)])))
        rows.append((10 * i + 1, " ".join([*fill(30), *w[2 * n // 3 :], *w[n // 3 : 2 * n // 3], *w[: n // 3], *fill(3)])))
        rows.append((10 * i + 2, " ".join([*w[n // 4 :], *fill(4), *w[: n // 4], *fill(20)])))
        rows.append((10 * i + 3, " ".join([*fill(8), *w[n // 2 :], *fill(n)])))
    bag = lambda w: Counter(tuple(w[j : j + 5]) for j in range(len(w) - 4))
    want = {}
    for d, t in rows:
        for i, u in items:
            a, b = t.split(), u.split()
            for s in range(max(len(a) - len(b), 0) + 1):
                x, y = bag(a[s : s + len(b)]), bag(b)
                both, either = sum((x & y).values()), sum((x | y).values())
                if both * 100 >= 75 * either and both / either > want.get((d, i), (0, 0))[0]:
                    want[d, i] = both / either, s
    got = decontaminate.matches(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id): (r.similarity, r.start) for r in got} == want
    assert {10 * i for i in range(12)} <= {d for d, _ in want}


def test_fingerprint_lanes(spark):
    """Counts in lanes give the bits that 64 single counts give, for every lane width."""
    rng = np.random.default_rng(3)
    rows = [rng.integers(-(2**63), 2**63 - 1, n).tolist() for n in (0, 1, 2, 3, 8, 125, 126, 127, 300, 32766, 32767)] + [[-1] * 126, [-1] * 127, [0] * 9]
    got = spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "i int, x array<long>").select("i", decontaminate.fingerprint(decontaminate.F.col("x")).alias("p")).collect()
    for r in got:
        x = np.array(rows[r.i], np.int64).astype(np.uint64)
        bits = sum(1 << b for b in range(64) if 2 * int(((x >> np.uint64(b)) & np.uint64(1)).sum()) > len(x))
        assert r.p % 2**64 == bits, r.i


def test_katz_reads_a_batch_row_by_row():
    """A batch may hold every chunk of a partition: a row is turned to Python when its turn comes."""
    import inspect

    import pyarrow as pa

    from ranklift.llm import katz

    batch = pa.RecordBatch.from_pydict({"x": [1, 2], "y": [[1], None]})
    rows = katz._rows(iter([batch, batch.slice(0, 0), batch.slice(1, 1)]))
    assert inspect.isgenerator(rows) and list(rows) == [{"x": 1, "y": [1]}, {"x": 2, "y": None}, {"x": 2, "y": None}]
    assert inspect.signature(katz.fit).parameters["chunk_tokens"].default <= 1_500_000


def _peak_bytes(work) -> int:
    import tracemalloc

    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_katz_holds_few_bytes_a_token(monkeypatch):
    import pyspark

    from ranklift.llm.words import pack

    monkeypatch.setattr(pyspark.TaskContext, "get", staticmethod(lambda: type("T", (), {"partitionId": lambda self: 0})()))
    rng = np.random.default_rng(1)
    texts = [" ".join(f"w{x}" for x in rng.zipf(1.3, 2000) % 20_000) for _ in range(500)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(500), pa.int64()), pa.array(texts), pa.array([False] * 500)], names=["doc_id", "text", "held"])
    chunks = []
    peak = _peak_bytes(lambda: chunks.extend(katz._encode([batch], 10_000_000)))
    (row,) = chunks[0].to_pylist()
    tokens, n = sum(row["size"]), row["n_words"]
    assert len(chunks) == 1 and tokens == 500 * 2001
    assert peak < 80 * tokens
    known = pa.RecordBatch.from_pylist([row | {"ids": pack(np.arange(n) + 2, 5), "counts": pack(np.ones(n, np.int64), 5)}])
    assert _peak_bytes(lambda: list(katz._events([known], 8, 1000, 500))) < 60 * tokens
    assert _peak_bytes(lambda: list(katz._pair_requests([known], 8, 1000, 500))) < 44 * tokens


def test_chunks_of_sets_hold_few_bytes_a_byte(monkeypatch):
    import pyspark

    monkeypatch.setattr(pyspark.TaskContext, "get", staticmethod(lambda: type("T", (), {"partitionId": lambda self: 0})()))
    rng = np.random.default_rng(2)
    batch = pa.RecordBatch.from_arrays([pa.array(range(400), pa.int64()), pa.array([" ".join(map(str, rng.integers(0, 10**6, 2000))) for _ in range(400)])], names=["doc_id", "text"])
    whole, sliced = [], []
    assert _peak_bytes(lambda: sliced.extend(ngram_jaccard._chunk_rows([batch], 5, 16 << 20))) < 10 * batch.nbytes
    whole.extend(ngram_jaccard._chunk_rows([batch], 5, 16 << 20, slice_bytes=1 << 30))
    assert len(whole) == 1 and sliced == whole
