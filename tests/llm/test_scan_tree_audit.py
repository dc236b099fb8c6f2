"""License scan, Merkle manifest and filter audit against brute force."""

import hashlib
import re
import zlib
from itertools import permutations

import duckdb
import pytest
from pyspark.sql import functions as F

from gazette.llm import filter_audit, license_scan, merkle
from tests.llm.conftest import TEXTS

FOLD = str.maketrans(license_scan.UPPER, license_scan.LOWER)


# --- license scan ---------------------------------------------------------------

def scan_brute(text, phrases=license_scan.PHRASES, templates=license_scan.TEMPLATES, threshold="0.9"):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))
    places, base = [], set()
    for phrase, label in phrases:
        p = phrase.split()
        at = [i for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
        places += at
        base |= {label} if at else set()
    labels, best = set(base), 0.0
    for kind, label, tokens, least in license_scan.template_sets(templates, threshold):
        for start in range(0, len(words), kind):
            if start and start + kind >= len(words):
                break
            o = len(set(tokens) & set(words[start:start + 2 * kind]))
            if o >= least:
                labels.add(label)
                best = max(best, o / len(tokens))
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)),
            1.0 if places else best)


MIT = license_scan.TEMPLATES[14][1]
NOTICES = [
    "Licensed under the Apache License, Version 2.0.", "x " * 15 + "Released under the MIT License" + " y" * 40,
    "cc by cc by CC-BY all rights reserved cc", "All  Rights\nReserved. GENERAL Public License general public license", MIT, MIT.replace("granted", "given"),
    MIT.replace("granted", "given").replace("charge", "cost").replace("person", "one").replace("copy", "part"), " ".join(reversed(MIT.split())),
    "a " * 9000 + "licensed under cc by nc 4 0 " + "b " * 9000, "allrightsreserved cc, by; ccc by cc byy", "licensed under the version 2 0 license",
]


def test_license_scan_equals_brute_force(spark, odd_docs):
    rows = [(100 + i, t, "en", None, "own", -1, True) for i, t in enumerate(NOTICES)] + [(100, NOTICES[2], "en", None, "own", -1, True)]
    docs = odd_docs.unionByName(spark.createDataFrame(rows, odd_docs.schema))
    found, blocks = license_scan.license_scan(docs)
    got = sorted((tuple(r) for r in found.drop("_row").collect()), key=repr)
    assert got == sorted(((r.doc_id, *scan_brute(r.text)) for r in docs.collect()), key=repr)
    hits = blocks.collect()
    assert hits and all(0.9 <= r.containment <= 1 for r in hits)
    labels = {r.doc_id: r.labels for r in found.filter("doc_id >= 103").collect()}
    assert labels[104] == "mit" and labels[105] == "mit" and labels[106] == "" and labels[107] == "mit"


def test_license_scan_of_nothing_and_other_templates(spark, odd_docs, no_docs):
    assert license_scan.license_scan(no_docs)[0].count() == 0
    one = odd_docs.limit(0).unionByName(spark.createDataFrame([(1, "one two three four", None, None, None, 0, False)], odd_docs.schema))
    found, _ = license_scan.license_scan(one, phrases=(("two three", "p"),), templates=(("t", "four three two one"),), threshold="0.75")
    assert found.select("n_base", "first_word", "last_word", "base_labels", "labels").first() == (1, 1, 1, "p", "p,t")
    with pytest.raises(ValueError, match="overlap"):
        license_scan.license_scan(one, phrases=(("a b a", "x"),))[0].count()


def test_license_scan_is_native(spark, odd_docs):
    plan = license_scan.license_scan(odd_docs)[0]._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoop", plan)


# --- Merkle manifest ----------------------------------------------------------------

def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_brute(row, low=False) -> str:
    out = ""
    for name in merkle.LEAF_COLUMNS:
        v = row[name]
        if v is not None:
            v = str(v).translate(FOLD) if low and name == "text" else str(v)
        out += "-" if v is None else f"{len(v.encode())}:{v}"
    return sha(out)


def tree_brute(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i:i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def way_brute(levels, i):
    out = []
    for level in levels[:-1]:
        start = i // 16 * 16
        out.append((i - start, level[start:start + 16]))
        i //= 16
    return out


def manifest_brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append(r)
    keys = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for k in keys:
        groups[k].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_brute(r)))
    trees = [tree_brute([leaf_brute(r) for r in groups[k]]) for k in keys]
    top = tree_brute([t[-1][0] for t in trees])
    out = []
    for j, k in enumerate(keys):
        for i, r in enumerate(groups[k]):
            way = way_brute(trees[j], i) + way_brute(top, j)
            proof = sha("".join(x for slot, kids in way for n, x in enumerate(kids) if n != slot))
            folded = leaf_brute(r, r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
            for slot, kids in way:
                folded = sha("".join(kids[:slot] + [folded] + kids[slot + 1:]))
            out.append((r["doc_id"], leaf_brute(r), trees[j][-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return sorted(out, key=repr)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, digest string, _g int"


@pytest.mark.parametrize("sizes", [[1], [2, 1, 16], [17, 256, 257, 0, 1], [4100, 3], [1] * 19])
def test_manifest_equals_brute_force(spark, sizes):
    rows = [(n * 7 + 5000 * g, None if g == 2 else f"s{'é' * (g % 3)}{g}", None if n % 3 else "en", n, f"Text {n % 11} ÄB", "x", 1)
            for g, size in enumerate(sizes) for n in range(size)]
    docs = spark.createDataFrame(rows[::-1], SCHEMA).repartition(5)
    got = merkle.manifest(merkle.document_leaves(docs))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == manifest_brute([r.asDict() for r in docs.collect()])


def test_manifest_of_nulls_repeats_and_nothing(spark):
    rows = [(None, "a", None, None, None, None, None), (None, "a", "en", 1, "X", None, None), (1, "a", "en", 1, "X", None, None),
            (1, "a", "en", 1, "X", None, None), (1, "a", "en", 1, "Y", None, None), (2, None, None, None, "", None, None), (3, "", None, None, "q" * 200_000, None, 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = merkle.manifest(merkle.document_leaves(docs)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == manifest_brute([r.asDict() for r in docs.collect()])
    assert merkle.manifest(merkle.document_leaves(docs.limit(0))).count() == 0


def test_a_fold_hashes_only_what_stands_right_of_the_slot():
    kids = [sha(str(i)) for i in range(16)]
    parent = merkle.Parent(kids)
    for k in range(16):
        assert parent.fold(k, kids[k]) == parent.digest == sha("".join(kids))
        assert parent.fold(k, "0" * 64) == sha("".join(kids[:k]) + "0" * 64 + "".join(kids[k + 1:]))
        own = hashlib.sha256("".join(kids[:k]).encode())
        assert parent.states[k].digest() == own.digest()
        # the copy decides, not the left siblings: without them the fold stays right
        bare = merkle.Parent(kids)
        bare.kids = [""] * k + kids[k:]
        assert bare.fold(k, "f" * 64) == parent.fold(k, "f" * 64)


# --- filter audit ---------------------------------------------------------------------

def audit_brute(docs, labels):
    good = {r["doc_id"] for r in labels if r["quality"] == 1} - {None}
    toxic = {r["doc_id"] for r in labels if r["toxic"] == 1} - {None}
    least = {}
    for r in docs:
        if r["doc_id"] is not None:
            t = r["text"] or ""
            least[t] = min(least.get(t, r["doc_id"]), r["doc_id"])
    parts = {}
    for r in docs:
        t, fails = r["text"] or "", set()
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails |= {"A"} if len(words) < 100 else set()
        fails |= {"B"} if 100 * len(set(words)) < 80 * len(words) else set()
        fails |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 10 * len(t) else set()
        fails |= {"D"} if re.search(r"[#$%&*|]", t) else set()
        fails |= {"E"} if r["doc_id"] is not None and r["doc_id"] > least[t] else set()
        parts.setdefault(r["lang"] or "", []).append((fails, r["doc_id"] in good, r["doc_id"] in toxic))
    out = []
    for part, rows in parts.items():
        total = dict.fromkeys("ABCDE", 0)
        lines = []
        for order in permutations("ABCDE"):
            left = rows
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[0]]
                left = [x for x in left if f not in x[0]]
                total[f] += len(gone)
                failing = sum(f in x[0] for x in rows)
                lines.append((part, "".join(order), step, len(left), len(gone), failing - len(gone), sum(x[0] == {f} for x in rows),
                              sum(x[1] for x in gone), sum(x[2] for x in gone), f))
        out += [(*x[:-1], total[x[-1]]) for x in lines]
    return sorted(out)


def test_audit_equals_brute_force(spark, odd_docs):
    long = " ".join(f"w{i}" for i in range(150))
    extra = [(60, long, None, None, "x", 1, True), (59, long, "de", None, "x", 1, True), (61, long + " A#", "", None, "x", 1, True), (62, long.upper(), "de", None, "x", 1, True),
             (63, "", "de", None, None, 1, True), (64, None, "de", None, None, 1, True), (None, long, "de", None, None, 1, True), (60, long, None, None, "x", 1, True),
             (60, "other", None, None, "x", 1, True), (70, "x " * 50_000, "fr", None, "x", 1, True)]
    docs = odd_docs.unionByName(spark.createDataFrame(extra, odd_docs.schema))
    labels = spark.createDataFrame([(60, 1, 0), (60, 1, 1), (61, None, 1), (None, 1, 1), (4, 1, None), (999, 1, 1)], "doc_id long, quality int, toxic int")
    got = filter_audit.filter_audit(docs, labels)
    assert sorted(map(tuple, got.collect())) == audit_brute([r.asDict() for r in docs.collect()], [r.asDict() for r in labels.collect()])


def test_audit_of_nothing_and_without_labels(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.filter_audit(no_docs, labels).count() == 0
    got = filter_audit.filter_audit(odd_docs.withColumn("filter", F.lit(1)), labels.withColumn("text", F.lit("")))
    assert sorted(map(tuple, got.collect())) == audit_brute([r.asDict() for r in odd_docs.collect()], [])


def test_relations_hold_only_failing_rows(spark, odd_docs):
    rows, failing = filter_audit.failing_ids(odd_docs)
    assert rows.count() == odd_docs.count() == len(TEXTS) + 3
    per_filter = {r["filter"]: r["count"] for r in failing.groupBy("filter").count().collect()}
    brute = audit_brute([r.asDict() | {"lang": ""} for r in odd_docs.collect()], [])
    assert per_filter == {x[1][0]: x[4] for x in brute if x[2] == 1 and x[4]}


def test_sql_of_the_audit_on_odd_rows(spark, odd_docs):
    con = duckdb.connect()
    documents, labels = odd_docs.select("doc_id", "text", "lang").toPandas().convert_dtypes(), None
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [tuple(r) for r in odd_docs.select("doc_id", "text", "lang").collect()])
    con.execute("CREATE TABLE labels (doc_id BIGINT, quality INT, toxic INT)")
    assert len(documents) and labels is None
    res = con.execute(filter_audit.OP13_SQL)
    want = sorted(res.fetchall())
    got = filter_audit.filter_audit(odd_docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert sorted(map(tuple, got.select(*[d[0] for d in res.description]).collect())) == want
