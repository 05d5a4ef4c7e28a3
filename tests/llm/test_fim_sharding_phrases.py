"""Fill-in-middle, sharding and phrases: odd rows, and plain versions of what they compute."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from trendstrata.llm import fim, phrases, sharding

DOCS = (
    "doc_id long, text string, lang string, source string, n_chars long, size long, shard int, slot long, "
    "row long, place long, form string, n long, word string, bucket long, grp long, _key string, _copies long"
)


def _words(n, seed, letters="abcdé"):
    r = random.Random(seed)
    return " ".join(r.choice(letters) + r.choice(letters) for _ in range(n))


def _rows(pairs):
    return [(i, t, lang, "s", 1, 2, 3, 4, 5, 6, "x", 7, "w", 8, 9, "k", 10) for i, t, lang in pairs]


@pytest.fixture(scope="module")
def docs(spark):
    texts = [
        None, "", " ", "a", "A b.c", "one <P> two", "x<S>", "<M>", "<", "<P", "a<", "ends with <", "é", "é<é", "\n\n", "naïve  café\ttab\x0bx",
        "< <P < S> <S", "😀 a😀b", "x" * 50_000, _words(30_000, 1), "1234567890" * 3000, "The the THE. The the, the",
    ]
    pairs = [(i, t, ["en", None, "und", "de"][i % 4]) for i, t in enumerate(texts)]
    pairs += [(100 + k, _words(60, k), "en") for k in range(40)]
    pairs += [(200 + k, "all the same text in a large group " * 3, "en") for k in range(60)]
    pairs += [pairs[4], pairs[4], (None, "no id " * 9, "de"), (None, None, None), (19, "another row of this id", "en")]
    return spark.createDataFrame(_rows(pairs), DOCS)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _transformed(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n, digest = len(units), _sha(f"1:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(digest[k : k + 8], 16) for k in (0, 8, 16, 24))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return (doc_id, n, "plain", None, None, text)
    lo, hi = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = ("".join(units[a:b]) for a, b in ((0, lo), (lo, hi), (hi, n)))
    if h4 % 100 < 20:
        return (doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}")
    return (doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}")


def test_fim_equals_the_plain_version(docs, nothing):
    rows = docs.collect()
    want = [_transformed(r["doc_id"], r["text"]) for r in rows]
    digests = [(*w[:5], _sha(w[5]), _sha(r["text"] or "")) for w, r in zip(want, rows, strict=True)]
    pieces = fim.transformed(docs)
    assert sorted(map(str, map(tuple, fim.digests(pieces).collect()))) == sorted(map(str, digests))
    assert sorted(map(str, map(tuple, fim.texts(pieces).collect()))) == sorted(str((w[0], w[2], w[5])) for w in want)
    assert {w[2] for w in want} == {"plain", "psm", "spm"}
    empty = fim.digests(fim.transformed(nothing))
    assert empty.count() == 0 and empty.columns[:3] == ["doc_id", "n", "form"]


def test_fim_marks_across_pieces():
    for form, order in fim.ORDERS.items():
        parts = {fim.PREFIX: "a<P<".encode(), fim.SUFFIX: "<S é<".encode(), fim.MIDDLE: b"<<M"}
        output = b"".join(mark + parts[mark] for mark in order)
        for step in (1, 2, 3, 5):
            restorer, found = fim._Restorer(form), defaultdict(bytes)
            for k in range(0, len(output), step):
                for part, _, chunk in restorer.feed(output[k : k + step]):
                    found[part] += chunk
            for part, _, chunk in restorer.end():
                found[part] += chunk
            assert {fim.PLACES[m]: t for m, t in parts.items()} == found


def test_fim_is_one_shuffle(docs):
    plan = fim.digests(fim.transformed(docs))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def _sharded(rows, shards, whole):
    """Rows in order with the shard of each."""
    key = lambda r: (hashlib.md5((r[1] or "").encode()).hexdigest(), hashlib.md5(str("" if r[0] is None else r[0]).encode()).hexdigest())
    rows = sorted(rows, key=key)
    size = [len((r[1] or "").encode()) + 8 for r in rows]
    total, groups = sum(size), defaultdict(lambda: [None, 0])
    start, starts = 0, []
    for r, s in zip(rows, size, strict=True):
        starts.append(start)
        group = groups[r[1] or ""]
        group[0] = start if group[0] is None else group[0]
        group[1] += s
        start += s
    out, slots = [], Counter()
    for r, s, at in zip(rows, size, starts, strict=True):
        first, whole_group = groups[r[1] or ""]
        if whole_group * shards <= total // whole:
            shard = (2 * first + whole_group) * shards // (2 * total)
        else:
            shard = (2 * at + s) * shards // (2 * total)
        out.append((r[0], s, zlib.crc32((r[1] or "").encode()), shard, slots[shard]))
        slots[shard] += 1
    return out


@pytest.mark.parametrize(("shards", "whole", "parts"), [(24, 64, 8), (3, 2, 8), (5, 1000, 50), (1, 64, 3)])
def test_sharding_equals_the_plain_version(spark, docs, shards, whole, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)  # the result must not depend on it
    try:
        found = [tuple(r) for r in sharding.shard_by_bytes(docs, shards, whole).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(map(str, found)) == sorted(map(str, _sharded([(r["doc_id"], r["text"]) for r in docs.collect()], shards, whole)))


def test_shards_are_nearly_equal_and_keep_small_groups(spark):
    texts = [(k, _words(30 + k % 7, k // 3), "en") for k in range(6000)] + [(10_000 + k, "hot text", "en") for k in range(3000)]
    found = sharding.shard_by_bytes(spark.createDataFrame(_rows(texts), DOCS)).collect()
    sizes = Counter()
    for r in found:
        sizes[r["shard"]] += r["size"]
    target = sum(sizes.values()) / 24
    assert set(sizes) == set(range(24))
    assert max(abs(s - target) for s in sizes.values()) <= target / 64 + max(r["size"] for r in found)
    of_text = defaultdict(set)
    for r in found:
        of_text[r["text_crc32"]].add(r["shard"])
    assert all(len(s) == 1 for c, s in of_text.items() if c != zlib.crc32(b"hot text"))
    hot = of_text[zlib.crc32(b"hot text")]
    assert hot == set(range(min(hot), max(hot) + 1))


def test_sharding_of_nothing_and_without_python(docs, nothing):
    assert sharding.shard_by_bytes(nothing).count() == 0
    plan = sharding.shard_by_bytes(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def _collocations(rows, least, within, top):
    grams, sizes = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate({k: k + 32 for k in range(65, 91)})):
            words = re.findall("[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for k in (1, 2, 3):
                grams[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in grams.items():
        kept = []
        for gram, a in f.items():
            if len(gram) == 1 or a < least:
                continue
            longer = [b for g, b in f.items() if len(g) == 3 and len(gram) == 2 and b >= least and gram in (g[:2], g[1:])] if len(gram) == 2 else []
            if any(100 * b >= within * a for b in longer):
                continue
            cuts = [(phrases.SCALE * a * a // (f[gram[:k]] * f[gram[k:]]), k) for k in range(1, len(gram))]
            score, k = min(cuts)
            kept.append((-score, -a, " ".join(gram).encode(), a, f[gram[:k]], f[gram[k:]]))
        kept.sort()
        out += [(lang, i + 1, p.decode(), a, l, r, sizes[lang], -s) for i, (s, _, p, a, l, r) in enumerate(kept[:top])]
    return out


@pytest.mark.parametrize(("parts", "memory"), [(8, phrases.MEMORY), (200, phrases.MEMORY), (3, 50)])
def test_phrases_equal_the_plain_version(spark, docs, parts, memory):
    """With many partitions or little memory, frequent words and pairs are divided between groups."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        docs = docs.filter("doc_id IS NULL OR doc_id <> 19")  # the plain version is slow
        found = phrases.collocations(*phrases.phrase_counts(docs, 3, memory), least=3, top=200).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = _collocations([(r["text"], r["lang"]) for r in docs.collect()], 3, phrases.WITHIN, 200)
    assert sorted(map(tuple, found)) == sorted(want) and len(want) > 50


def test_phrases_of_nothing(nothing):
    nodes, sizes = phrases.phrase_counts(nothing)
    assert phrases.collocations(nodes, sizes).count() == 0


def test_scores_beyond_64_bits(spark):
    big = 3_000_000_000_000
    nodes = [("en", 1, "a", None, None, 2 * big), ("en", 1, "b", None, None, 3 * big), ("en", 2, "a", "b", None, big)]
    found = phrases.collocations(
        spark.createDataFrame(nodes, phrases.NODES), spark.createDataFrame([("en", 9 * big)], "lang string, n long")
    )
    assert [tuple(r) for r in found.collect()] == [("en", 1, "a b", big, 2 * big, 3 * big, 9 * big, 166_666)]


def test_stretches_end_where_pieces_do(monkeypatch):
    text = b"aa bb. cc dd, ee" + b" ff" * 20 + b"! gg hh"
    whole = phrases.words_of(text)
    monkeypatch.setattr(phrases, "SLICE", 12)
    cut = [phrases.words_of(s) for s in phrases._stretches(text)]
    assert len(cut) > 2
    told = lambda w: [(w.known[a], w.known[b - 1] if b else None) for a, b in zip(w.ids, w.after(1), strict=True)]
    assert [t for w in cut for t in told(w)] == told(whole)
