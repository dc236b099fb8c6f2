"""Jaccard join and substring dedup against brute force; components; the pipeline."""

import hashlib
import random
import re

import numpy as np
import pytest

import corpus_pipeline as CP
from gazette.llm import components as C
from gazette.llm import jaccard_join as J
from gazette.llm import substring_dedup as S

WORD = re.compile("[^\x20\x09-\x0d]+")
SCHEMA = "doc_id long, text string, region int, n_shingles string, __text int"


def frame(spark, docs):
    return spark.createDataFrame([(i, t, 1, "x", 2) for i, t in docs], SCHEMA)


def shingles(text, k):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute_components(docs, k, num, den):
    sets = [shingles(t, k) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    first = {}
    for i, (d, _) in enumerate(docs):
        first[find(i)] = min(first.get(find(i), d), d)
    return {d: (len(sets[i]), first[find(i)]) for i, (d, _) in enumerate(docs)}


def near_copies(seed, vocab=4000, originals=25):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocab)]
    line = " ".join(rng.choices(words, k=30))
    docs = []
    for o in range(originals):
        n = rng.choice([3, 6, 9, 14, 25, 60, 150, 400])
        base = rng.choices(words, k=n)
        for _ in range(rng.choice([1, 1, 2, 5, 25])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
                at = rng.randrange(len(copy) or 1)
                copy[at:at + rng.randint(0, 1)] = rng.choices(words, k=rng.randint(0, 2))
            docs.append(" ".join(copy) + (f" {line}" if rng.random() < 0.3 else ""))
    rng.shuffle(docs)
    return [(i * 3 + 1, t if rng.random() < 0.9 else t.upper()) for i, t in enumerate(docs)]


@pytest.mark.parametrize("limits", [{}, {"region_docs": 12, "region_shingles": 1500}])
@pytest.mark.parametrize("k,num,den", [(4, 85, 100), (5, 80, 100)])
def test_jaccard_matches_brute_force(spark, limits, k, num, den):
    docs = near_copies(k) + [(5000, None), (5002, ""), (5005, "two words"), (5008, "TWO words"), (5011, " \n"), (5014, "one")]
    want = brute_components(docs, k, num, den)
    got = J.jaccard_components(frame(spark, docs), width=k, num=num, den=den, **limits).collect()
    assert len(got) == len(docs)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert len({c for _, c in want.values()}) < len(docs) - 10


def test_jaccard_odd_rows(spark, odd_docs, no_docs):
    got = J.jaccard_components(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r.component_id)
    assert by[4] == [4, 4] and by[50] == [11] and by[11] == [11] and by[None] == [None] and by[0] == [0] and by[1] == [1]
    assert J.jaccard_components(no_docs).count() == 0
    kept = J.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(4) == 1 and 50 not in ids and 11 in ids and None in ids


def test_equal_ids_with_different_texts_are_one_node(spark):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(900)]
    short, long_ = " ".join(rng.choices(words, k=40)), " ".join(rng.choices(words, k=500))
    docs = [(7, short), (7, long_), (9, short + " end"), (11, long_ + " end"), (12, "start " + short)]
    got = J.jaccard_components(frame(spark, docs)).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(7, 7), (7, 7), (9, 7), (11, 7), (12, 7)]


def test_signatures_meet_for_all_linked_sets():
    """Every linked pair of random sets of all small sizes shares a signature."""
    rng = np.random.default_rng(2)
    for num, den in ((85, 100), (80, 100)):
        shells = J.Shells(num, den)
        for n in [*range(1, 40), 57, 90, 140, 333]:
            x = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
            sets = [x]
            for _ in range(12):
                drop, add = rng.integers(0, n // 5 + 2, 2)
                y = np.unique(np.concatenate([rng.permutation(x)[drop:], rng.integers(0, 2**63, add).astype(np.uint64)]))
                if len(y) and den * len(np.intersect1d(x, y)) >= num * len(np.union1d(x, y)):
                    sets.append(y)
            keys, owner = J.signatures(sets, shells)
            own = [set(keys[owner == i].tolist()) for i in range(len(sets))]
            assert all(own[0] & o for o in own)


def test_region_joins_recursively():
    rng = np.random.default_rng(4)
    sets = []
    for _ in range(30):
        base = rng.integers(0, 2**62, 200).astype(np.uint64)
        for _ in range(12):
            sets.append(np.unique(np.concatenate([rng.permutation(base)[: 200 - rng.integers(0, 40)], rng.integers(0, 2**62, rng.integers(0, 20)).astype(np.uint64)])))
    ids = np.arange(len(sets)) * 2 + 5
    region = J.Region(sets, 85, 100)
    a, b = region.links(ids)
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if 100 * len(np.intersect1d(sets[i], sets[j])) >= 85 * len(np.union1d(sets[i], sets[j])):
                root[find(ids[i])] = find(ids[j])
    want = [min(int(j) for j in ids if find(j) == find(i)) for i in ids]
    hub = dict(zip(b.tolist(), a.tolist()))
    assert [hub.get(int(i), int(i)) for i in ids] == want
    assert region.compared < len(sets) ** 2 / 3


def test_components(spark):
    rng = random.Random(0)
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, 1000 + i) for i in range(1, 50)] + [(rng.randint(2000, 2400), rng.randint(2000, 2400)) for _ in range(150)]
    edges = [(a, b) if rng.random() < 0.5 else (b, a) for a, b in edges if a != b]
    df = spark.createDataFrame(edges, "a long, b long").repartition(7)
    got = {r.node: r.component for r in C.components(df, "test").collect()}
    x, y = C.forest(*np.array(edges).T)
    want = {i: i for e in edges for i in e} | dict(zip(x.tolist(), y.tolist()))
    assert got == want and got[300] == 0 and got[1049] == 1000
    assert C.components(df.filter("a < 0"), "none").count() == 0


def brute_substrings(docs, window):
    words = [WORD.findall(t or "") for _, t in docs]
    seen = {}
    for w in words:
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            seen[k] = seen.get(k, 0) + 1
    out = []
    for (d, _), w in zip(docs, words):
        gone = {i + j for i in range(len(w) - window + 1) if seen[tuple(w[i:i + window])] > 1 for j in range(window)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def passages(seed):
    rng = random.Random(seed)
    words = [f"x{i}" for i in range(300)]
    shared = [rng.choices(words, k=n) for n in (34, 35, 36, 60, 120)]
    docs = []
    for i in range(70):
        parts = [rng.choices(words, k=rng.randint(0, 120))]
        for _ in range(rng.randint(0, 2)):
            p = rng.choice(shared)
            a = rng.randint(0, len(p) // 3)
            parts += [p[a:len(p) - rng.randint(0, 9)], rng.choices(words, k=rng.randint(0, 60))]
        docs.append((i, " ".join(w for p in parts for w in p)))
    docs += [(100, docs[3][1]), (101, docs[3][1].replace(" ", "\n\t")), (102, " ".join(["same"] * 90)), (103, " ".join(["ab", "cd", "ef"] * 40)),
             (104, " ".join(words[:36] + words[:36])), (105, None), (106, ""), (107, " ".join(["same"] * 35)), (108, " ".join(words[:20] * 3))]
    return docs


@pytest.mark.parametrize("limits", [{}, {"hot_key": 2, "index_words": 300}, {"gram": 5, "index_words": 2000}])
def test_substrings_match_brute_force(spark, limits):
    docs = passages(1)
    got = S.dedup_report(frame(spark, docs), **limits).collect()
    have = sorted(((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept_text).hexdigest()) for r in got), key=str)
    assert have == brute_substrings(docs, 35)


def test_substring_odd_rows(spark, odd_docs, no_docs):
    got = S.dedup_report(odd_docs).collect()
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert sorted(((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept_text).hexdigest()) for r in got), key=str) == brute_substrings(docs, 35)
    assert S.dedup_report(no_docs).count() == 0
    twice = odd_docs.filter("doc_id = 11").unionByName(odd_docs.filter("doc_id = 11"))
    assert [r.n_removed for r in S.dedup_report(twice).collect()] == [400, 400]
    left = S.remove_repeats(odd_docs, chars_col="n_words")
    assert left.columns == odd_docs.columns
    rows = {r.doc_id: r for r in left.collect()}
    assert 11 not in rows and rows[0].text is None and rows[5].text == docs[5][1]


def test_segments_cover_windows_and_agree():
    """Segments part all windows of all texts, equal windows have equal keys,
    equal content hashes mean equal words, repeats within one are marked."""
    from gazette.llm.common import hashed_words

    rng = random.Random(8)
    texts = [" ".join(str(rng.randint(0, 3)) for _ in range(rng.randint(0, 90))) for _ in range(40)]
    texts += [texts[3], "", None, "a b " * 30, "x " * 10, " ".join(str(i) for i in range(60))]
    words = [(t or "").split() for t in texts]
    window, gram = 9, 4
    h, counts = hashed_words([None if t is None else t.encode() for t in texts])
    assert counts.tolist() == [len(w) for w in words] and len(set(h.tolist())) == len({x for w in words for x in w})
    seen, keys, contents = set(), {}, {}
    for d, key, content, a, b, twice in zip(*(x.tolist() for x in S.runs(h, counts, window, gram))):
        for i in range(a, b + 1):
            assert (d, i) not in seen
            seen.add((d, i))
            assert keys.setdefault(tuple(words[d][i:i + window]), key) == key
        part = tuple(words[d][a:b + window])
        assert contents.setdefault((key, content), part) == part
        inside = [part[i:i + window] for i in range(b - a + 1)]
        assert twice or len(set(inside)) == len(inside)
    assert seen == {(d, i) for d, w in enumerate(words) for i in range(len(w) - window + 1)}


def test_fm_index_counts():
    rng = np.random.default_rng(0)
    sequences = [rng.integers(1, 5, rng.integers(1, 60)) for _ in range(25)]
    again = rng.random(25) < 0.3
    index = S.FmIndex(sequences, again)
    text = [int(x) for x in index.text]
    places = np.repeat(1 + again, [len(s) + 1 for s in sequences]).tolist()
    for which, s in enumerate(sequences):
        begin = int(index.first[which])
        for end in range(begin, begin + len(s)):
            got = int(index.reach(np.array([end]), np.array([begin]))[0])
            want = begin - 1
            for j in range(end, begin - 1, -1):
                p = text[j:end + 1]
                if sum(places[i] for i in range(len(text)) if text[i:i + len(p)] == p) < 2:
                    want = j
                    break
            assert got == want


def test_every_removed_word_comes_from_an_index(spark, odd_docs, monkeypatch):
    """Copies and passages go to the index like all other segments: marked
    ones are found by it, and without its answers nothing is removed."""
    a, b = " ".join(f"a{i}" for i in range(50)), " ".join(f"b{i}" for i in range(40))
    assert S.shard_spans([(a.encode(), True), (b.encode(), False), (("b0 b1 b2 " + a.split(" ", 1)[1]).encode(), False)], 35) == [[(0, 50)], [], [(3, 52)]]
    assert sum(r.n_removed for r in S.dedup_report(odd_docs).collect()) > 0
    nothing = spark.createDataFrame([], "key long, content long, f long, t long")
    monkeypatch.setattr(S, "search_shards", lambda *_: nothing)
    assert {r.n_removed for r in S.dedup_report(odd_docs).collect()} == {0}


def test_many_equal_rows(spark):
    """Copies under one id and under many: each place loses the same words."""
    passage = " ".join(f"p{i}" for i in range(45))
    docs = [(1, f"{passage} own words")] * 300 + [(k, f"{passage} own words") for k in range(2, 200)] + [(900, f"x y {passage} z")]
    got = S.dedup_report(spark.createDataFrame(docs, "doc_id long, text string").repartition(7), hot_key=50).collect()
    assert {(r.n_words, r.n_removed) for r in got if r.doc_id < 900} == {(47, 47)} and len(got) == 499
    assert [(r.n_words, r.n_removed) for r in got if r.doc_id == 900] == [(48, 45)]


def test_pipeline_matches_brute_force(spark, tmp_path):
    """Every stage's decisions, one after the other, on a small fixture."""
    import json

    import zstandard
    from tokenizers import Tokenizer

    from gazette.llm import decontaminate as D
    from gazette.llm import quality_rules as Q
    from gazette.llm.common import tokenizer_path
    from tests.llm.test_rules_tokens import brute_hits, check_packing

    rng = random.Random(12)
    syllables = "ba de fi go lu ma ne pi ro su ta ve wi xo yu za".split()
    words = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(700)]
    prose = lambda n: " ".join(rng.choices(words, k=n))
    passage, bench = prose(60), prose(30)
    docs = [prose(rng.randint(40, 200)) for _ in range(30)]
    docs += [docs[0], docs[1].replace(docs[1].split()[20], "zzz", 1), f"{prose(80)} {passage} {prose(50)}", f"{passage} {prose(70)}", f"{prose(30)} {bench} {prose(30)}",
             "short", "", None, "spam eggs " * 200, passage]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(docs)]
    sf = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(0, bench)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    compress = zstandard.ZstdCompressor(level=3).compress
    left = [(i, t) for i, t, *_ in rows if Q.judge((t or "").encode(), compress, 10, 20)[-1]]
    groups = brute_components(left, 5, 80, 100)
    left = [(i, t) for i, t in left if groups[i][1] == i]
    seen = {}
    for _, t in left:
        w = t.split()
        for k in range(len(w) - 34):
            seen[tuple(w[k:k + 35])] = seen.get(tuple(w[k:k + 35]), 0) + 1
    cut = []
    for i, t in left:
        w = t.split()
        gone = {k + j for k in range(len(w) - 34) if seen[tuple(w[k:k + 35])] > 1 for j in range(35)}
        if gone:
            t = " ".join(x for k, x in enumerate(w) if k not in gone)
        if t:
            cut.append((i, t))
    hits = brute_hits(cut, [(0, bench)])
    left = [(i, t) for i, t in cut if not hits[i][1]]
    assert 25 < len(left) < 33 and {34, 35, 36, 37, 38} & {i for i, _ in left} == set()
    tok = Tokenizer.from_file(tokenizer_path())
    tokens = {i: np.array([*tok.encode(t, add_special_tokens=False).ids, 1], "<u4") for i, t in left}
    got = CP.run(spark, sf).collect()
    assert {r.doc_id for r in got} == set(tokens)
    check_packing(got, tokens)
    names = [n for n, _ in CP.STAGES]
    assert len(names) == 5 and json.dumps(names)
    docs_df = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in CP.STAGES[:-1]:
        docs_df = stage(spark, docs_df, sf)
        assert docs_df.schema.names == ["doc_id", "text", "lang", "source", "n_chars"]
    assert D.keep_clean(docs_df.limit(0), spark.read.parquet(f"{sf}/benchmark.parquet")).count() == 0


@pytest.mark.parametrize("limits", [{}, {"region_docs": 3, "region_shingles": 300}])
def test_keep_one_groups_rows_not_ids(spark, limits):
    """Unlike texts under one id stay, copies without an id go, and which row stays doesn't depend on the order of rows."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(900)]
    a, b, c, d = (" ".join(rng.choices(words, k=60)) for _ in range(4))
    docs = [(7, a), (7, b), (7, a), (9, a + " end"), (None, b), (None, c), (None, c), (None, c + " end"), (3, d), (None, d), (20, ""), (21, ""), (22, None)]
    rows = [(i, t, k, {"k": "v"}) for k, (i, t) in enumerate(docs)] + [(7, b, 1, {"k": "v"})]
    stays = set()
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        got = J.keep_one(spark.createDataFrame(rows, "doc_id long, text string, lang int, extra map<string,string>").repartition(3), **limits)
        assert got.columns == ["doc_id", "text", "lang", "extra"]
        kept = got.collect()
        assert [(i, t) for i, t in ((r.doc_id, r.text) for r in kept) if i] and len(kept) == 7
        found = {(r.doc_id, r.text) for r in kept}
        assert {(7, a), (7, b), (3, d), (20, ""), (21, ""), (22, None)} < found and len(found & {(None, c), (None, c + " end")}) == 1
        stays.add(tuple(sorted(map(str, kept))))
    assert len(stays) == 1


def test_stages_keep_columns_with_clashing_names(spark):
    from gazette.llm import jaccard_join, substring_dedup

    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, long, 10, "a", 1, "x", 2), (2, long + " more", 20, "b", 2, None, 3), (3, None, 30, None, None, "z", 4)]
    names = "doc_id long, text string, __row int, __key string, __spans int, _key string, c0 int"
    docs = spark.createDataFrame(rows, names)
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns and sorted(map(tuple, kept.collect())) == [rows[0], rows[2]]
    cut = substring_dedup.remove_repeats(docs, chars_col=None)
    assert cut.columns == docs.columns and sorted(map(tuple, cut.collect())) == [(2, "more", *rows[1][2:]), rows[2]]
