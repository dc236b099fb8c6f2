"""URL filter: host word segmentation and multinomial naive Bayes.

Concatenated names in hosts and paths are split into words by a unigram
Viterbi search; a naive Bayes model over the host's and path's words judges
the URLs that no rule decides.  Words are counted over the prose of all pages
(URLs and dotted names in it are names, not prose), a word that is put together
from far more frequent ones is no word of its own, and the model learns from
all URLs that a rule decides.  Both tables are whole and
stay in the shared folder: URLs are judged in blocks, and a block's task holds
only the words that its names contain and the tokens of its names.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazette.llm.common import batch, bounded_batches, partitions, raw, staged, table

RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
#: URLs, and their bytes, that are judged together with the words and tokens they need.
BLOCK_ROWS, BLOCK_BYTES = 8192, 1 << 20
TAG = re.compile(rb"<(?:script|style)\b.*?</(?:script|style)\s*>|<[^<>]*>", re.S | re.I)
TOKEN = re.compile(r"\d+|[^\W\d_]+")
WORDS = re.compile(r"[^\W\d_]+").findall
#: A URL or dotted name in prose (linear: it only begins where a run of such letters begins).
NAME = re.compile(r"(?<![\w.-])(?:[a-z][a-z0-9+]*+://\S++|[\w-]++(?:\.[\w-]++)++(?:[:/?#]\S*+)?)")
#: A listed word is a compound if listed words of two letters or more, each this many times as frequent, make it up.
COMPOUND = 10
#: Base of the substring keys (odd, so that its powers have inverses modulo 2**64) and what each letter of length adds.
BASE, LENGTH = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): the host with A-Z in lower case; both empty without ``://``."""
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    path = re.split(r"[?#]", rest[end:], maxsplit=1)[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end]), path


class Rules:
    """A rule is ``host/path-prefix`` and fits its host and all subdomains."""

    def __init__(self, rules=RULES):
        self.by_host: dict[str, list[tuple[str, str, str]]] = {}
        for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r)):
            host, _, path = rule.partition("/")
            self.by_host.setdefault(host, []).append(("/" + path, rule, verdict))

    def match(self, host: str, path: str) -> tuple[str | None, str | None]:
        """(rule, verdict) of the longest rule that fits, or two Nones."""
        best: tuple[str, str] | None = None
        labels = host.split(".")
        for i in range(len(labels)):
            for prefix, rule, verdict in self.by_host.get(".".join(labels[i:]), ()):
                if path.startswith(prefix):
                    if best is None or len(rule) > len(best[0]):
                        best = (rule, verdict)
                    break
        return best or (None, None)


def automaton(values: dict):
    """Finds all keys in a text, in time linear in the text and the finds; None without keys."""
    if not values:
        return None
    out = ahocorasick.Automaton()
    for word, value in values.items():
        out.add_word(word, (len(word), value))
    out.make_automaton()
    return out


def compounds(counts: dict[str, int]) -> set[str]:
    """Listed words made up of listed words that are each COMPOUND times as
    frequent: concatenated names that prose repeats, which would else hide
    their own parts.  Whether a word is one depends on its substrings only."""
    found, out = automaton(counts), set()
    for word, count in counts.items():
        rarest = [math.inf] + [0] * len(word)    # of the best parts up to here
        for end, (size, n) in found.iter(word):
            if 2 <= size < len(word):
                rarest[end + 1] = max(rarest[end + 1], min(rarest[end + 1 - size], n))
        if rarest[-1] >= COMPOUND * count:
            out.add(word)
    return out


class Segmenter:
    """Unigram Viterbi: the likeliest split of a name into listed words that are
    no compounds.  A run of letters that is no listed word costs ten times a word
    seen once, and ten times more for each letter after its first.  ``total`` is the count of all words where ``counts`` holds only some."""

    def __init__(self, counts: dict[str, int], memory: int = 100_000, total: int | None = None):
        total = (sum(counts.values()) if total is None else total) + 1
        joined = compounds(counts)
        self.cost = {w: math.log(total / n) for w, n in counts.items() if w not in joined}
        self.words = automaton(self.cost)
        self.unknown, self.step = math.log(total) + math.log(10), math.log(10)
        self.seen: dict[str, list[str]] = {}
        self.memory = memory

    def split(self, name: str) -> list[str]:
        if name in self.seen:
            return self.seen[name]
        best, back, at = [0.0] * (len(name) + 1), [0] * (len(name) + 1), 0
        run, began = math.inf, 0     # cost and start of the best unlisted run that ends here
        for end, word in chain(self.words.iter(name) if self.words else (), [(len(name) - 1, None)]):
            while at <= end:     # an unlisted run, unless a word that ends here is likelier
                run += self.step
                if best[at] + self.unknown < run:
                    run, began = best[at] + self.unknown, at
                at += 1
                best[at], back[at] = run, began
            if word and best[at - word[0]] + word[1] < best[at]:
                best[at], back[at] = best[at - word[0]] + word[1], at - word[0]
        out, end = [], len(name)
        while end:
            out.append(name[back[end]:end])
            end = back[end]
        if len(self.seen) >= self.memory:
            self.seen.clear()
        self.seen[name] = out[::-1]
        return self.seen[name]

    def tokens(self, host: str, path: str) -> list[str]:
        """Words of host (``h:``) and path (``p:``); a number counts by its length."""
        out = []
        for kind, part in name_parts(host, path):
            out += [f"{kind}#{len(part)}"] if part[0].isdigit() else [kind + w for w in self.split(part)]
        return out


class NaiveBayes:
    def __init__(self, counts: dict[str, dict[str, int]], documents: dict[str, int], sums: dict[str, int], distinct: int, alpha: float = 1.0):
        """counts: by verdict, of the tokens to be judged; sums and distinct: of all
        tokens; a token without a count has the smoothed weight of none."""
        self.verdicts = sorted(documents)
        n = sum(documents.values())
        self.prior = {v: math.log(documents[v] / n) for v in self.verdicts}
        self.total = {v: sums.get(v, 0) + alpha * (distinct + 1) for v in self.verdicts}
        self.weight = {t: [math.log((counts.get(v, {}).get(t, 0) + alpha) / self.total[v]) for v in self.verdicts] for t in {t for c in counts.values() for t in c}}
        self.other = [math.log(alpha / self.total[v]) for v in self.verdicts]

    def verdict(self, tokens: list[str]) -> tuple[str, float]:
        """(the likelier verdict, log odds of block)."""
        scores = [self.prior[v] for v in self.verdicts]
        for t in tokens:
            scores = [s + w for s, w in zip(scores, self.weight.get(t, self.other))]
        if len(self.verdicts) == 1:
            return self.verdicts[0], 0.0
        odds = scores[self.verdicts.index("block")] - scores[self.verdicts.index("allow")]
        return ("block" if odds > 0 else "allow"), odds


def name_parts(host: str, path: str) -> list[tuple[str, str]]:
    """Runs of letters or digits with ``h:`` or ``p:`` for host or path."""
    return [(kind, part) for kind, text in (("h:", host), ("p:", path.lower())) for part in TOKEN.findall(text)]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def substring_keys(names: list[str], lengths=None):
    """64-bit keys of substrings, equal for equal strings wherever they stand:
    the key of each whole name, or with ``lengths`` one array of distinct keys
    for each of these lengths, of all substrings that long.  Strings that share
    a key by chance cost a needless row, as words are looked up as strings."""
    size = np.fromiter(map(len, names), np.int64, len(names))
    letters = np.frombuffer("".join(names).encode("utf-32-le"), np.uint32).astype(np.uint64)
    upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum((letters + np.uint64(1)) * _powers(BASE, len(letters))[:-1], dtype=np.uint64)])
    back = _powers(pow(BASE, -1, 1 << 64), len(letters))

    def keys(at, long):
        return ((upto[at + long] - upto[at]) * back[at] + np.asarray(long).astype(np.uint64) * np.uint64(LENGTH)).view(np.int64)

    ends = np.cumsum(size)
    if lengths is None:
        return keys(ends - size, size)
    room = np.repeat(ends, size) - np.arange(len(letters))
    return (np.unique(keys(np.flatnonzero(room >= n), np.array([n]))) for n in lengths if n <= size.max(initial=0))


def prose(page: bytes) -> str:
    """Visible text in lower case without URLs and dotted names."""
    return NAME.sub(" ", TAG.sub(b" ", page).decode("utf-8", "replace").lower())


def word_counts(pages: DataFrame, html_col: str) -> DataFrame:
    """(word, n, key) of every word of all pages' prose, counted in each task
    first, so a word that stands everywhere moves once a task."""
    rows = pages.select(F.col(html_col).cast("string").alias("h"))
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def run(batches):
        seen: Counter = Counter()
        read = 0

        def flush():
            out = batch(schema, list(seen), list(seen.values()))
            seen.clear()
            return out

        for b in batches:
            for h in raw(b.column(0)):
                text = prose(h or b"")
                seen.update(WORDS(text))
                read += len(text)
            if len(seen) > 500_000 or read > 1 << 27:
                yield flush()
                read = 0
        yield flush()

    def keyed(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(substring_keys(b.column(0).to_pylist()), pa.int64())], ["word", "n", "key"])

    counts = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return staged(counts.mapInArrow(keyed, "word string, n long, key long"), "words")


def dealt(pages: DataFrame, url_col: str, id_col: str) -> DataFrame:
    """(_block, _id, _url): rows in blocks as they are read, by number and bytes."""
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).cast("string").alias("_url"))

    def run(batches):
        from pyspark import TaskContext

        block, n, size = TaskContext.get().partitionId() << 32, 0, 0
        for b in batches:
            own = []
            for u in raw(b.column(1)):
                if n and (n >= BLOCK_ROWS or size + len(u or b"") > BLOCK_BYTES):
                    block, n, size = block + 1, 0, 0
                own.append(block)
                n, size = n + 1, size + len(u or b"")
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), b.column(0), b.column(1)], ["_block", "_id", "_url"])

    return staged(rows.mapInArrow(run, f"_block long, _id {rows.schema['_id'].dataType.simpleString()}, _url string"), "urls")


def block_words(urls: DataFrame, words: DataFrame, lengths: list[int]) -> DataFrame:
    """(_block, word, n) of every counted word that stands in a name of the
    block.  A substring is joined once a block, however many names hold it."""
    schema = pa.schema([("_block", pa.int64()), ("key", pa.int64())])

    def run(batches):
        names: set[str] = set()
        now = None

        def flush():
            for keys in substring_keys(list(names), lengths):
                for i in range(0, len(keys), 100_000):
                    part = keys[i:i + 100_000]
                    yield batch(schema, np.full(len(part), now), part)
            names.clear()

        for b in batches:
            for block, u in zip(b.column(0).to_pylist(), raw(b.column(1))):
                if block != now:
                    yield from flush()
                    now = block
                names.update(w for _, w in name_parts(*split_url((u or b"").decode("utf-8", "replace"))) if not w[0].isdigit())
        yield from flush()

    return urls.select("_block", "_url").mapInArrow(run, "_block long, key long").join(words, "key").select("_block", "word", "n")


def by_block(rows: DataFrame, own: DataFrame, run, schema: str) -> DataFrame:
    """run(rows, own entries) of each block; a block stands in one task of many."""
    n = partitions(rows.sparkSession)
    own = own.withColumnRenamed("_block", "_own").withColumn("_own", F.col("_own") + 0)  # a column of its own: both come from rows
    return rows.repartition(n, "_block").groupBy("_block").cogroup(own.repartition(n, "_own").groupBy("_own")).applyInArrow(run, schema)


def filter_urls(pages: DataFrame, url_col: str = "url", html_col: str = "html", id_col: str = "page_id", rules=RULES) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, n_tokens, log_odds.

    A null URL or one without ``://`` has an empty host and path and gets the
    method's verdict (the likelier class); without any rule-decided URL the
    method allows; even odds allow.  Repeated rows and null ids are judged row
    by row; extra columns are ignored; an empty table gives an empty result.
    Whole pages are counted and whole URLs split, in time linear in their
    length and the words found in them.
    """
    bounded_batches(pages.sparkSession)
    known = Rules(rules)
    words = word_counts(pages, html_col)
    by_length = {r.size: r.n for r in words.groupBy(F.length("word").alias("size")).agg(F.sum("n").alias("n")).collect()}
    total, lengths = sum(by_length.values()), sorted(by_length)
    urls = dealt(pages, url_col, id_col)
    kind = urls.schema["_id"].dataType.simpleString()
    fields = "host string, path string, rule string, verdict string"

    def cut(rows, own):
        segmenter = Segmenter(dict(zip(own.column("word").to_pylist(), own.column("n").to_pylist())), total=total)
        out = []
        for u in raw(rows.column("_url").combine_chunks()):
            host, path = split_url((u or b"").decode("utf-8", "replace"))
            out.append((host, path, *known.match(host, path), segmenter.tokens(host, path)))
        columns = zip(*out) if out else [[] for _ in range(5)]
        types = [pa.string()] * 4 + [pa.list_(pa.string())]
        return pa.table([rows.column("_block"), rows.column("_id"), *(pa.array(list(c), t) for c, t in zip(columns, types))],
                        ["_block", "_id", "host", "path", "rule", "verdict", "tokens"])

    split = staged(by_block(urls, block_words(urls, words, lengths), cut, f"_block long, _id {kind}, {fields}, tokens array<string>"), "split")
    documents = {r.verdict: r.n for r in split.filter("verdict is not null").groupBy("verdict").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not documents:
        return split.select(F.col("_id").alias(id_col), "host", "path", "rule", F.lit("allow").alias("verdict"),
                            F.size("tokens").cast("long").alias("n_tokens"), F.lit(0.0).alias("log_odds"))
    verdicts = sorted(documents)
    tokens = split.filter("verdict is not null").select("verdict", F.explode("tokens").alias("token"))
    counts = staged(tokens.groupBy("token").agg(*(F.count_if(F.col("verdict") == v).alias(v) for v in verdicts)), "tokens")
    whole = counts.agg(F.count(F.lit(1)).alias("_distinct"), *(F.sum(v).alias(v) for v in verdicts)).first()
    sums, distinct = {v: whole[v] or 0 for v in verdicts}, whole["_distinct"]

    def judge(rows, own):
        names = own.column("token").to_pylist()
        model = NaiveBayes({v: dict(zip(names, own.column(v).to_pylist())) for v in verdicts}, documents, sums, distinct)
        found = rows.column("tokens").to_pylist()
        got = [model.verdict(t) for t in found]
        final = [v or m for v, (m, _) in zip(rows.column("verdict").to_pylist(), got)]
        return pa.table([rows.column("_id"), *(rows.column(c) for c in ("host", "path", "rule")), pa.array(final, pa.string()),
                         pa.array([len(t) for t in found], pa.int64()), pa.array([o for _, o in got], pa.float64())],
                        ["_id", "host", "path", "rule", "verdict", "n_tokens", "log_odds"])

    needed = split.select("_block", F.explode("tokens").alias("token")).distinct().join(counts, "token")
    return by_block(split, needed, judge, f"_id {kind}, {fields}, n_tokens long, log_odds double").withColumnRenamed("_id", id_col)


def op4_url_filter(spark, sf_dir: str) -> DataFrame:
    d = filter_urls(table(spark, sf_dir, "pages"))
    return d.select("page_id", "host", "path", "rule", "verdict", "n_tokens", F.round("log_odds", 6).alias("log_odds"))
