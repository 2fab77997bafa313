"""What the operators decide, recomputed in plain Python on small tables."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SF_SMALL

from ranklift.llm import line_dedup, packing, quality, shard_tree, url_lists

LINE = " ".join(f"w{i}" for i in range(12))


@pytest.mark.parametrize("hot", [1000, 1])
def test_equal_lines_of_any_length_go(spark, hot):
    rows = [(1, "Of.\n\n \nno spaces at all\n日本語のテキスト"), (2, "Of.\n\n \n日本語のテキスト\na\tb"), (3, "a\tb\n" + LINE), (4, LINE.replace(" ", "\t") + "\nof."), (5, LINE.replace("w3", "x"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    gone = sorted((r.doc_id, r.line_no, r.kind) for r in line_dedup.duplicate_lines(docs, hot=hot).collect())
    # the tab-separated line has the words of line 12, the last differs in one
    assert gone == [(2, 0, "exact"), (2, 3, "exact"), (3, 0, "exact"), (4, 0, "near"), (5, 0, "near")]


def test_prefixes_begin_anywhere_and_hosts_have_no_case(spark):
    entries = [("a", "prefix", "Ok.org/x/"), ("b", "prefix", "b.org/"), ("c", "prefix", "c.org"), ("d", "prefix", "d.org/priv"), ("e", "prefix", "e.org/En")]
    entries = spark.createDataFrame([(*e, 1, "add") for e in entries], "list string, kind string, pattern string, at long, action string")
    urls = [("http://ok.ORG/x/1", "a"), ("http://ok.org/x", ""), ("http://b.org", "b"), ("http://b.org?q", "b"), ("https://c.org/any", "c"), ("http://c.org.uk/", ""), ("http://d.org/private/1", "d"), ("http://d.org/pri", ""), ("http://e.org/en", ""), ("http://e.org/English", "e"), ("http://xb.org/", "")]
    got = url_lists.evaluate(spark.createDataFrame([(u, 5, w) for u, w in urls], "url string, fetched_at long, want string"), entries).collect()
    assert len(got) == len(urls) and all(r.lists == r.want for r in got), [r for r in got if r.lists != r.want]


def test_equal_values_meet_the_thresholds_of_their_group(spark):
    """The same text is ordinary in a source full of symbols and far out in one without."""
    rng = np.random.default_rng(1)
    prose = lambda n: " ".join("".join(rng.choice(list("abcdefgh"), 5)) for _ in range(n))
    code = lambda k: " ".join("".join(rng.choice(list("abcdefgh"), 4)) + "#" * int(k) for _ in range(60))
    same = code(2)
    rows = [(i, prose(60), "en", "prose") for i in range(80)] + [(100 + i, code(1 + i % 3), "en", "code") for i in range(80)] + [(200, same, "en", "prose"), (201, same, "en", "code"), (202, prose(60) + " 5% # $", "en", "prose")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality.verdicts(docs).collect()}
    assert not kept[200] and kept[201] and kept[202]
    assert all(kept[i] for i in range(80)) and all(kept[100 + i] for i in range(80))


def test_shards_by_drawing_again(spark):
    """Every row's shard by a descent in plain Python."""

    def draw(key, name, weight):
        bits = int(hashlib.md5(f"{key}|{name}".encode()).hexdigest()[:13], 16)
        return -math.log((bits + 0.5) / 2**52) / weight

    def descend(key, leaves):
        tree = defaultdict(lambda: defaultdict(list))
        for x in leaves:
            tree[x.region][x.rack].append(x)
        region = min(tree, key=lambda r: draw(key, r, sum(x.weight for xs in tree[r].values() for x in xs)))
        rack = min(tree[region], key=lambda k: draw(key, f"{region}/{k}", sum(x.weight for x in tree[region][k])))
        return min(tree[region][rack], key=lambda x: draw(key, f"{region}/{rack}/{x.shard}", x.weight)).shard

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    rows = shard_tree.shard_documents(docs).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 16, zlib.crc32(data), "key")
        assert r.shard == descend(r.doc_id, shard_tree.layout(40)) and r.grown_shard == descend(r.doc_id, shard_tree.layout(41))


def test_packed_pieces_hold_every_id_in_order(spark):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public.path("word_bpe_49k.json")
    reference = Tokenizer.from_file(path)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    ids = {r.doc_id: [*reference.encode(r.text or "", add_special_tokens=False).ids, 1] for r in docs.collect()}
    rows = packing.pack_texts(docs, path, with_ids=False).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        assert zlib.crc32(np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))

    def gapless(spans):
        spans = sorted(spans)
        return spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:])) and spans[-1][0] + spans[-1][1]

    assert set(pieces) == set(ids) and all(gapless(x) == len(ids[i]) for i, x in pieces.items())
    used = [gapless(x) for x in sequences.values()]
    assert all(0 < n <= 2048 for n in used) and sum(used) == sum(map(len, ids.values()))


# ------------------------------------------------------------------ the pipeline's stages


def shingles(text):
    w = (text or "").translate({i: i + 32 for i in range(65, 91)}).split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set()


def test_near_duplicate_stage_loses_no_text_of_its_own(spark):
    import corpus_pipeline

    base, other, third = (" ".join(f"{p}{i}" for i in range(60)) for p in "abc")
    near = base.replace("a30", "z")
    rows = [(1, base), (5, base), (5, other), (7, third), (7, third.replace("c9", "y")), (None, near), (None, "alone and null"), (8, ""), (9, None), (3, other + " end"), (8, ""), (1, base)]
    docs = spark.createDataFrame([(i, t, "clash", "clash") for i, t in rows], "doc_id long, text string, component_id string, n_shingles string").repartition(3)
    out = corpus_pipeline.near_duplicates(spark, docs, "")
    assert out.columns == docs.columns
    got = Counter((r.doc_id, r.text) for r in out.collect())
    sevens = [(7, third), (7, third.replace("c9", "y"))]
    assert sum(got.pop(x, 0) for x in sevens) == 1  # one of two near copies under one id
    assert got == Counter([(1, base), (3, other + " end"), (None, "alone and null"), (8, ""), (9, None)])
    assert corpus_pipeline.near_duplicates(spark, docs.where("false"), "").count() == 0


def test_stages_against_sql_and_brute_force(spark, tmp_path):
    """Each stage's kept rows on what the stage before it kept, by DuckDB or in Python."""
    import corpus_pipeline as c
    import duckdb

    from ranklift.llm.oracles import ORACLES

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").coalesce(4)
    for number, (name, stage) in enumerate(c.STAGES[:-1]):
        docs.coalesce(1).write.parquet(f"{tmp_path}/in{number}")
        docs = spark.read.parquet(f"{tmp_path}/in{number}")
        con = duckdb.connect()
        con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/in{number}/*.parquet')")
        con.execute(f"CREATE VIEW benchmark AS SELECT * FROM read_parquet('{SF_SMALL}/benchmark.parquet')")
        before = {r.doc_id: r.text for r in docs.collect()}
        out = stage(spark, docs, SF_SMALL).coalesce(4).cache()
        got = {r.doc_id: r.text for r in out.collect()}
        ask = lambda q, cols: con.sql(f"SELECT {cols} FROM ({ORACLES[q]})").fetchall()
        if name == "quality_rules":
            want = {i: before[i] for i, kept in ask("op3_adaptive_quality", "doc_id, kept") if kept}
        elif name == "line_dedup":
            gone = set(ask("op7_line_dedup", "doc_id, line_no"))
            want = {i: t if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone) for i, t in before.items()}
        elif name == "ngram_jaccard":
            parent = {i: i for i in before}
            root = lambda x: x if parent[x] == x else root(parent[x])
            by, sets = defaultdict(list), {i: shingles(t) for i, t in before.items()}
            for i, s in sets.items():
                for x in s:
                    by[x].append(i)
            for a, b in {(a, b) for x in by.values() for a in x for b in x if a < b}:
                if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    lo, hi = sorted((root(a), root(b)))
                    parent[hi] = lo
            want = {i: before[i] for i in before if root(i) == i}
        else:
            held = {i for (i,) in ask("op9_benchmark_decontamination", "DISTINCT doc_id")}
            want = {i: t for i, t in before.items() if i not in held}
        assert got == want, (name, len(got), len(want))
        assert name != "line_dedup" or all(r.n_chars == len(r.text) for r in out.collect() if r.text is not None)
        docs = out


def test_components_of_unfitting_sizes_form_no_pairs(spark):
    """Many near copies and one fragment in their bucket: nothing is left to verify; a component
    of fitting size meets each of them once."""
    from ranklift.llm import ngram_jaccard

    schema = "token long, sid long, n long, component long, rest long"
    copies = [(1, s, 100 + s % 3, 10, 90) for s in range(10, 3010)]
    fragment, other = (1, 5000, 30, 5000, 25), (1, 6000, 95, 6000, 85)
    pairs = lambda rows: ngram_jaccard._apart(spark.createDataFrame(rows, schema), 75).count()
    assert pairs([*copies, fragment]) == 0
    assert pairs([*copies, fragment, other]) == 3000
    assert pairs([*copies, fragment, (2, 10, 100, 10, 90), (2, 6000, 95, 6000, 85)]) == 1


def test_hot_classes_by_broadcast_and_by_join(spark):
    from ranklift.llm import ngram_jaccard

    text = " ".join(f"t{i}" for i in range(40))
    rows = [(i, text) for i in range(30, 10, -1)] + [(100 + i, f"{text} {i}") for i in range(5)] + [(200, "alone with its own few words here"), (None, text), (201, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = sorted(((i, 11 if t and t.startswith("t0") else i) for i, t in rows), key=repr)
    for hot in (1000, 2, 1):
        got = sorted(((r.doc_id, r.component_id) for r in ngram_jaccard.near_duplicates(docs, hot=hot).collect()), key=repr)
        assert got == want
