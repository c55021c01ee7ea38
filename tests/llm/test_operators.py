"""Each operator against brute force, and on nulls, empty and repeated rows, empty tables and clashing names."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tabloom.llm import (
    ball_tree,
    decontaminate,
    language,
    line_dedup,
    packing,
    quality,
    simhash,
    token_store,
    toxicity,
    url_rules,
)
from tabloom.llm.token_ids import default_path, encoder

DOCS = "doc_id long, text string"
rng = random.Random(7)
SYLLABLES = ["ba", "co", "di", "fu", "ga", "he", "ki", "lo"]


def prose(words: int) -> str:
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 3))) for _ in range(words))


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


# --- 1: decontamination ---


def hits_by_hand(words, items, window):
    hit, names = set(), set()
    for name, own in items:
        size = min(window, len(own))
        runs = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else set()
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in runs:
                hit.update(range(i, i + size))
                names.add(name)
    return hit, names


def test_automaton_against_brute_force():
    for _ in range(300):
        letters = [bytes([97 + i]) for i in range(rng.choice([1, 2, 4]))]
        items = [(str(i), [rng.choice(letters) for _ in range(rng.randint(0, 9))]) for i in range(rng.randint(0, 6))]
        automaton = decontaminate.Automaton(items, 3)
        words = [rng.choice([*letters, b"z"]) for _ in range(25)]
        spans, names = automaton.scan(words)
        hit, wanted = hits_by_hand(words, items, 3)
        assert {i for a, b in spans for i in range(a, b)} == hit and names == wanted


@pytest.fixture(scope="module")
def leaks(spark):
    passage = prose(14)
    docs = [(1, f"{prose(20)} {passage.upper()}, {prose(5)}"), (2, prose(30)), (3, None), (4, ""), (5, "!?"), (6, passage), (6, passage), (None, passage)]
    items = [(10, passage), (11, passage), (12, None), (13, ""), (14, prose(40)), (None, prose(12)), (15, "tiny item")]
    return docs + [(7, "a TINY  item."), (8, prose(5000) + " " + passage)], items


def test_contamination_rows(spark, leaks):
    docs, items = leaks
    extra = frame(spark, docs).withColumn("n_hit", F.lit("own"))
    for bound in (1_000_000, 20):  # one block, several blocks
        rows = decontaminate.contamination(extra, frame(spark, items, "item_id long, text string"), max_words=bound, keep=("text",)).collect()
        assert len(rows) == len(docs)
        named = [(str(i), decontaminate.words_of(t)) for i, t in items if i is not None]
        for r in rows:
            words = decontaminate.words_of(r.text)
            hit, names = hits_by_hand(words, named, 10)
            assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (len(words), len(hit), len(names), bool(hit))
            assert r.items_sha256 == hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()


def test_clean_drops_or_cuts(spark, leaks):
    docs, items = leaks
    table, bench = frame(spark, docs).withColumn("n_hit", F.lit("own")), frame(spark, items, "item_id long, text string")
    kept = decontaminate.clean(table, bench)
    assert kept.columns == ["doc_id", "text", "n_hit"]
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 5]
    cut = {r.doc_id: r.text for r in decontaminate.clean(table, bench, max_share=0.9).collect()}
    assert decontaminate.words_of(cut[1]) == decontaminate.words_of(docs[0][1])[:20] + decontaminate.words_of(docs[0][1])[34:]
    assert 6 not in cut and cut[7] == "a TINY  item." and cut[3] is None


def test_no_items_and_no_documents(spark):
    none = frame(spark, [], "item_id long, text string")
    assert [r.contaminated for r in decontaminate.contamination(frame(spark, [(1, "a b")]), none).collect()] == [False]
    assert decontaminate.contamination(frame(spark, []), none).collect() == []


# --- 2: packing ---


def test_local_search_keeps_documents_and_saves_bins():
    for sizes in ([400, 350, 300, 513], list(range(1, 1025)), [7, 3, 4, 6]):
        lengths = [rng.choice(sizes) for _ in range(500)]
        start, end = packing.best_fit(lengths, 1024), packing.pack_lengths(lengths, 1024)
        assert sorted(i for b in end for i in b) == list(range(500))
        assert all(0 < sum(lengths[i] for i in b) <= 1024 for b in end) and len(end) <= len(start)
    # Best fit leaves three bins; exchanges empty one.
    lengths = [6, 5, 5, 4, 2, 2]
    search = packing.LocalSearch(lengths, [[0, 4], [1, 3], [2, 5]], 12)
    assert len(search.run()) == 2


def test_pieces_and_sequences(spark):
    docs = [(1, prose(2000)), (2, None), (3, ""), (4, prose(50)), (4, prose(50)), (None, prose(9)), (5, prose(20_000))]
    table = frame(spark, docs).withColumn("length", F.lit("own"))
    rows = packing.pack(packing.pieces(table, default_path()), shard_pieces=16).collect()
    own = encoder(default_path())
    wanted = []
    for doc_id, text in docs:
        ids = own.encode(text) + (2).to_bytes(4, "little")
        cuts = [0, *range(len(ids) // 4 % 1024 or 1024, len(ids) // 4 + 1, 1024)]
        wanted += [(doc_id, i, a, b - a, zlib.crc32(ids[4 * a : 4 * b])) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(map(key, ((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows))) == sorted(map(key, wanted))
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for members in bins.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.pack(packing.pieces(frame(spark, []), default_path())).collect() == []


# --- 3 and 10: classifiers ---


def test_toxicity_on_held_out_texts(spark):
    docs = [(i, prose(40) + (" you scoundrel " if i % 3 == 0 else " ") + prose(40)) for i in range(600)]
    labels = [(i, int(i % 3 == 0)) for i in range(400)] + [(None, 1), (3, None), (0, 1)]
    docs += [(1000, None), (1001, ""), (1002, prose(50_000) + " scoundrel")]
    model = toxicity.fit(frame(spark, docs), frame(spark, labels, "doc_id long, toxic int"))
    scores = {r.doc_id: r.score for r in toxicity.score(frame(spark, docs).withColumn("score", F.lit("own")), model).collect()}
    assert len(scores) == len(docs) and all(0 <= s <= 1 for s in scores.values())
    assert all((scores[i] >= 0.7) == (i % 3 == 0) for i in range(400, 600))
    assert scores[1002] >= 0.7 and scores[1000] == scores[1001] < 0.7


def test_toxicity_without_two_classes(spark):
    docs = frame(spark, [(1, "a"), (2, None)])
    for rows, value in (([], 0.0), ([(1, 0)], 0.0), ([(1, 1)], 1.0)):
        model = toxicity.fit(docs, frame(spark, rows, "doc_id long, toxic int"))
        assert all(abs(r.score - value) < 1e-3 for r in toxicity.score(docs, model).collect())


def test_ordinal_gradient_and_order():
    import numpy as np

    rows = np.arange(300)
    level = rows % 3
    weights, cuts = quality.cumulative_link(rows, level * 0, level - 1.0, level, 3, 1, 1e-4, 200)
    assert cuts[0] < cuts[1] and weights[0] > 0
    assert abs(cuts[0] + cuts[1]) < 0.02 * cuts[1]  # the data are symmetric


def test_quality_grades_held_out_texts(spark):
    def text(grade):
        return " ".join(w + ("!!%" if rng.random() < (0.5, 0.15, 0.0)[grade] else "") for w in prose(80).split())

    docs = [(i, text(i % 3)) for i in range(600)] + [(1000, None), (1001, "")]
    ratings = [(i, i % 3) for i in range(400)] + [(None, 1), (5, None)]
    model = quality.fit(frame(spark, docs), frame(spark, ratings, "doc_id long, grade int"))
    assert model.thresholds == sorted(model.thresholds) and model.grades == [0, 1, 2]
    rows = {r.doc_id: r for r in quality.judge(frame(spark, docs), model, 2).collect()}
    assert len(rows) == len(docs)
    assert sum(round(rows[i].expected_grade) == i % 3 for i in range(400, 600)) > 180
    assert all(0 <= r.tail_probability <= 1 and 0 <= r.expected_grade <= 2 for r in rows.values())
    none = quality.fit(frame(spark, docs), frame(spark, [], "doc_id long, grade int"))
    assert {r.expected_grade for r in quality.judge(frame(spark, docs), none, 1).collect()} == {0.0}


# --- 4: line dedup ---


def dedup_by_hand(docs, min_length, min_docs):
    key = lambda line: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    holders = defaultdict(set)
    for doc_id, text in docs:
        for line in (text or "").split("\n"):
            if doc_id is not None and len(key(line)) >= min_length:
                holders[key(line)].add(doc_id)
    out = []
    for doc_id, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc_id is None or len(holders[key(x)]) < min_docs or doc_id == max(holders[key(x)])]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def test_line_dedup_against_brute_force(spark):
    shared = [prose(9) for _ in range(6)]
    docs = [(i, "\n".join([*rng.choices(shared, k=3), prose(10), "\t" + shared[0].upper() + " ", "", prose(1)])) for i in range(30)]
    docs += [(40, None), (41, ""), (42, "\n\n"), (None, shared[0]), (3, shared[1]), (3, shared[1]), (43, shared[0])]
    table = frame(spark, docs).withColumn("n_lines", F.lit("own"))
    got = line_dedup.drop_shared_lines(table, min_length=20).collect()
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    mine = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in got), key=key)
    assert mine == sorted(dedup_by_hand(docs, 20, 5), key=key)
    assert line_dedup.drop_shared_lines(frame(spark, [])).collect() == []


# --- 5: language ---


def test_language_words_then_grams(spark):
    sounds = {"aa": ["ka", "to", "mi"], "bb": ["sch", "ung", "zei"]}
    word = lambda lang: "".join(rng.choice(sounds[lang]) for _ in range(rng.randint(2, 4)))
    docs = [(i, " ".join(word(lang) for _ in range(30)), lang) for i in range(200) for lang in [("aa", "bb")[i % 2]]]
    table = frame(spark, [*docs, (900, "x", None), (None, "katomi", "bb"), (901, None, "aa")], "doc_id long, text string, lang string")
    model = language.fit(language.learned_rows(table, "doc_id", F.col("doc_id") >= 100))
    new = [(i, " ".join(word(lang) for _ in range(3)), lang) for i in range(100) for lang in [("aa", "bb")[i % 2]]]
    odd = [(500, None, "und"), (501, "", "und"), (502, "12 ?!", "und"), (503, "zeizeizeizeiungung " * 9000, "bb")]
    asked = frame(spark, new + odd, "doc_id long, text string, score string")
    rows = language.predict(asked, model, keep=("doc_id", "score")).toDF("doc_id", "wanted", "lang", "sure").collect()
    assert all(r.lang == r.wanted and 0 <= r.sure <= 1 for r in rows) and len(rows) == 104
    kept = language.keep_identified(asked, model)
    assert kept.columns == asked.columns and kept.count() == 101
    nothing = language.fit(frame(spark, [], "doc_id long, text string, lang string"))
    assert {r.lang_pred for r in language.predict(asked, nothing).collect()} == {"und"}


# --- 6: top-k ---


def test_top_k_against_brute_force(spark):
    import math

    rows = [(i, [rng.gauss(0, 0.2) for _ in range(8)]) for i in range(400)]
    rows += [(i, [0.5] * 8) for i in range(400, 700)]  # ties
    rows += [(700, None), (701, [1.0, None]), (702, [float("nan")] * 8), (703, [float("inf")] * 8), (704, [0.3] * 3), (None, [0.1] * 8), (800, []), (100, [0.1] * 8)]
    table = frame(spark, rows, "vec_id long, embedding array<float>")
    got = ball_tree.top_k(table, F.col("id") % 100 == 0, shard_rows=64, block_queries=3).collect()
    import numpy as np

    whole = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole.append((i, [math.floor(1024 * float(np.float32(x))) for x in v] + [0] * (8 - len(v))))
    queries = {}
    for i, v in whole:
        if i % 100 == 0:
            queries[i] = min(queries.get(i, v), v)
    wanted = []
    for q, v in queries.items():
        best = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in whole if i != q)[:10]
        wanted += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(wanted)


def test_top_k_few_rows_and_large_numbers(spark):
    table = frame(spark, [(0, [3e15, 1.0]), (1, [2e15, 1.0])], "vec_id long, embedding array<double>")
    got = ball_tree.top_k(table, F.col("id") == 0).collect()
    assert [(r.vec_id, r.score) for r in got] == [(1, 2**63 - 1)]
    assert ball_tree.top_k(frame(spark, [], "vec_id long, embedding array<float>"), F.col("id") == 0).collect() == []


# --- 7: SimHash ---


def components_by_hand(codes, distance):
    root = {c: c for c in codes}

    def find(c):
        while root[c] != c:
            c = root[c]
        return c

    for a in codes:
        for b in codes:
            if a < b and bin(a ^ b).count("1") <= distance:
                root[find(b)] = find(a)
    return {c: find(c) for c in codes}


@pytest.mark.parametrize("max_group", [4, 4000])
def test_links_join_all_close_fingerprints(spark, max_group):
    base = [rng.getrandbits(64) for _ in range(20)] + [0]
    codes = {rng.choice(base) ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for _ in range(250)}
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    edges = simhash.links(frame(spark, [(c,) for c in signed], "fp long"), 2, max_group)
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    same = defaultdict(set)
    for c, s in zip(codes, signed):
        same[got.get(s, s)].add(c)
    wanted = defaultdict(set)
    for c, r in components_by_hand(codes, 2).items():
        wanted[r].add(c)
    assert sorted(map(sorted, same.values())) == sorted(map(sorted, wanted.values()))


def fingerprint_by_hand(text, shingle):
    import xxhash

    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lowered) if w]
    runs = [" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or ([" ".join(words)] if words else [])
    values = [xxhash.xxh64_intdigest(r.encode(), seed=42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def test_near_groups(spark):
    text = prose(400)
    docs = [(5, text), (9, text), (3, text.upper()), (11, text + " end"), (20, None), (21, ""), (22, " \n"), (30, prose(300)), (30, "x"), (None, text), (31, "É\xa0b c"), (32, "two words")]
    rows = simhash.near_groups(frame(spark, docs).withColumn("fp", F.lit("own")), shingle=3).collect()
    assert len(rows) == len(docs)
    marks = {(d, fingerprint_by_hand(t, 3)) for d, t in docs}
    assert {(r.doc_id, int(r.fingerprint, 16)) for r in rows} == marks
    groups = components_by_hand({m for _, m in marks}, 2)
    for r in rows:
        mates = [d for d, m in marks if groups[m] == groups[int(r.fingerprint, 16)] and d is not None]
        assert r.component_id == min(mates)
    kept = simhash.keep_one(frame(spark, docs), shingle=3).collect()
    assert len({r.doc_id for r in kept}) == len(kept) and {3, 20, 30} <= {r.doc_id for r in kept}
    assert simhash.near_groups(frame(spark, [])).collect() == []


# --- 8: token store ---


def test_shards_round_trip_and_random_access():
    for _ in range(20):
        letters = rng.choice([1, 2, 50])
        docs = [[rng.randrange(letters) for _ in range(rng.choice([1, 3, 400]))] for _ in range(rng.randint(1, 30))]
        reader = token_store.ShardReader(token_store.shard_file([token_ids(d) for d in docs], letters))
        assert reader.all_ids().tolist() == [i for d in docs for i in d]
        for n, d in enumerate(docs):
            a, b = rng.randrange(len(d) + 1), rng.randrange(len(d) + 2)
            assert reader.document(n) == d and reader.document(n, a, b) == d[a:b]


def token_ids(ids):
    from tabloom.llm.token_ids import packed

    return packed(ids)


def test_store_gives_back_all_documents(spark, tmp_path):
    docs = [(i, prose(rng.randint(0, 60))) for i in range(100)] + [(500, None), (501, ""), (7, "again"), (None, "null"), (502, prose(5000))]
    rng.shuffle(docs)
    path = str(tmp_path / "store")
    token_store.write_shards(frame(spark, docs).withColumn("start", F.lit("own")), path, default_path(), shard_tokens=1000)
    rows = token_store.read_shards(spark, path).orderBy("start").collect()
    own = encoder(default_path())
    end = (0).to_bytes(4, "little")
    wanted = sorted((-1 if d is None else d, zlib.crc32(own.encode(t) + end), len(own.encode(t)) // 4 + 1) for d, t in docs)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.ids_crc32, r.n_tokens) for r in rows) == wanted
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens
    order = [-1 if r.doc_id is None else r.doc_id for r in rows]
    assert order == sorted(order)
    assert spark.read.parquet(path).count() > 1
    empty = str(tmp_path / "empty")
    token_store.write_shards(frame(spark, []), empty, default_path())
    assert token_store.read_shards(spark, empty).collect() == []


# --- 9: URL rules ---


def test_url_parts_and_fixed_rules(spark):
    from tabloom.llm.queries import URL_RULES

    urls = ["http://A.Net/x", "https://example.net/en/1", "http://m.example.net/en", "http://example.com/de/?q", "http://notexample.com/de/", "http://x.org/fr/#t",
            "no scheme", None, "", "http://", "http://net", "ftp://a.net:80/y", "http://a.org/en?b=://c", "http://a.com/\nz"]
    pages = frame(spark, list(enumerate(urls)), "page_id long, url string").withColumn("verdict", F.lit("own"))
    rows = {r.page_id: r for r in url_rules.judge(pages, URL_RULES).collect()}
    assert len(rows) == len(urls)
    assert [(rows[i].rule, rows[i].verdict) for i in (0, 1, 2, 3, 5)] == [
        ("net/", "block"), ("example.net/en/", "allow"), ("net/", "block"), ("example.com/de/", "block"), ("org/fr/", "allow")]
    assert [rows[i].rule for i in (4, 6, 7, 8, 9, 10, 11)] == [None] * 7
    assert (rows[7].host, rows[7].path) == (rows[6].host, rows[6].path) == ("", "")
    assert (rows[10].host, rows[10].path, rows[12].host, rows[12].path) == ("net", "", "a.org", "/en")
    assert url_rules.judge(frame(spark, [], "page_id long, url string"), URL_RULES).collect() == []


def test_mined_rules(spark):
    rows = [(["a", "b"], "block")] * 9 + [(["a", "c"], "allow")] * 9 + [(["b", "c"], "block"), (["d"], None), ([], "block")]
    rules = url_rules.mine(frame(spark, rows, "tokens array<string>, verdict string"), min_support=0.1)
    got = {(tuple(r.needs), r.verdict): (round(r.confidence, 3), r.seen) for r in rules.collect()}
    assert got == {(("b",), "block"): (1.0, 10), (("c",), "allow"): (0.9, 10), (("a", "c"), "allow"): (1.0, 9)}
    urls = frame(spark, [(1, ["b", "x"]), (2, ["a"]), (3, ["a", "c"]), (4, [])], "r long, tokens array<string>")
    assert {r.r: r.verdict for r in url_rules.apply_rules(urls, rules, "r").collect()} == {1: "block", 3: "allow"}
