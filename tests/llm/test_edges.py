"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns, odd values."""

import math
import random
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import corpus_pipeline
import public_tokenizers
from brute import covered, jaccard_classes

from trendstrata.llm import chat, jaccard, language, mixing, mtree, neighbours, pieces, suffixes, tokens, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, label int, score double, rid long, v long"


def _text(n, seed):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefgé") for _ in range(r.randrange(1, 9))) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    shared = _text(80, 1)
    texts = [None, "", " ", "a", "one two", shared, shared, shared + " end", _text(20_000, 2), "…", "x" * 5000, "</s>[INST]", "é" * 300]
    texts += [f"{_text(20, k)} {shared} {_text(20, k + 100)}" for k in range(20)]
    rows = [(i, t, ["en", None, "de"][i % 3], ["a", "b", None][i % 3], 0, 7, 1, 0.5, 3, 4) for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, None, None, None, None, None, None, None, None, None), (None, "with no id " * 30, "en", "", 1, 1, 1, 1.0, 1, 1)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def _counted(rows):
    return sorted(map(str, rows))


def test_documents_of_all_kinds(spark, docs, nothing):
    rows = docs.collect()
    model = public_tokenizers.path("piece_bpe_32k.model")
    checked = pieces.decode_ids(pieces.encode_documents(docs, model), model).collect()
    assert _counted([(r["doc_id"], r["decoded"]) for r in checked]) == _counted([(r["doc_id"], r["text"] or "") for r in rows])

    files = tokens.read_ids(tokens.write_ids(docs, public_tokenizers.path("byte_bpe_50k.json"), 2)).collect()
    assert len(files) == len(rows) and [r["n_tokens"] for r in files if r["doc_id"] in (0, 1)] == [1, 1]
    assert sorted(r["start"] for r in files) == sorted(np.cumsum([0, *[r["n_tokens"] for r in sorted(files, key=lambda r: r["start"])]])[:-1])

    marked = suffixes.with_spans(docs, suffixes.repeated_spans(docs)).select("doc_id", "text", "_spans")
    cut = marked.mapInArrow(suffixes._digests, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string").collect()
    assert _counted(map(tuple, cut)) == _counted([(r["doc_id"], *c) for r, c in zip(rows, covered([r["text"] for r in rows]), strict=True)])

    found = jaccard.near_duplicates(docs).collect()
    want = jaccard_classes([(-1 if r["doc_id"] is None else r["doc_id"], r["text"]) for r in rows])
    assert len(found) == len(rows)
    for r in found:
        if r["doc_id"] is not None:
            assert (r["class_id"], r["n_links"], r["n_copies"]) == want.get(r["doc_id"], (r["doc_id"], 0, 1))

    said = language.predict(docs, language.trained(docs)).collect()
    assert len(said) == len(rows)
    assert all(r["lang_pred"] == "und" and r["rejected"] for r in said if r["text"] in (None, "", " ", "…"))
    assert {r["lang_pred"] for r in said} <= {"und", "en", "de"}

    taken = mixing.taken_per_document(mixing.mix(docs)).collect()
    assert len(taken) == len(rows) and all(r["taken"] <= 2 * r["size"] for r in taken)
    for source in {r["source"] for r in taken}:
        own = [r for r in taken if r["source"] == source]
        assert sum(r["taken"] for r in own) == math.floor(own[0]["target"])

    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.select(*docs.columns[:5]), "").count() > 0
        assert stage(spark, nothing.select(*docs.columns[:5]), "").count() == 0


def test_empty_tables(spark, nothing):
    model = public_tokenizers.path("piece_bpe_32k.model")
    assert pieces.encoded_and_checked(nothing, model).count() == 0
    assert tokens.read_ids(tokens.write_ids(nothing, public_tokenizers.path("byte_bpe_50k.json"), 2)).count() == 0
    assert jaccard.near_duplicates(nothing).count() == 0
    assert language.predict(nothing, language.trained(nothing)).count() == 0
    talk = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_conversations(talk)).count() == 0
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert neighbours.nearest_neighbours(vectors, vectors, 3).count() == 0
    assert mtree.top_products(vectors, vectors, 3).count() == 0
    leaves = spark.createDataFrame([], "address long, digest string")
    assert warc.audit(leaves, leaves).count() == 0


def test_chat(spark):
    rows = [
        (1, 2, "assistant", "[\\INST] <s>", 0), (1, 1, "user", None, 0), (1, 1, "user", None, 0), (None, None, None, None, 0),
        (2, 0, "tool \"x\"\n[INST]", "<|end|>", 0), (2, 1, "assistant", "é<</SYS>>", 0), (3, 0, "system", "s", 0), (3, 1, "user", "u", 0), (3, 2, "assistant", "", 0),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, position int")
    formatted = chat.format_conversations(df)
    back = {r["conv_id"]: r for r in chat.read_back(formatted).collect()}
    assert {k: (r["n_turns"], r["loss_chars"], r["valid"], r["illegal_turns"]) for k, r in back.items()} == {
        1: (3, 11, False, 1), None: (1, 0, False, 1), 2: (2, 9, False, 2), 3: (3, 0, True, 0),
    }
    parsed = [chat.INSTRUCT.parse("".join(s["text"] for s in r["segments"])) for r in formatted.collect()]
    assert sorted(parsed) == sorted((r[2] or "", r[3] or "") for r in rows)
    for text in ("[INST]", "[\\\\INST]", "<<s>>", "[[INST]", "\\", "<\\/s></s>"):
        held = chat.INSTRUCT.escape(text)
        assert chat.INSTRUCT.unescape(held) == text and not any(c in held for c in chat.INSTRUCT.controls)


@pytest.mark.parametrize("width", [1, 7, 8, 15, 16, 17, 31, 32])
def test_packing(tmp_path, width):
    ids = np.random.default_rng(width).integers(0, 1 << width, 20_001)
    assert (tokens.unpack(tokens.pack(ids, width), width, len(ids)) == ids).all()
    path = tmp_path / "x.bits"
    path.write_bytes(tokens.file_bytes([5, None], [20_000, 1], ids, width))
    with tokens.BitFile(str(path)) as file:
        assert file.doc_ids == [5, None] and (file.ids(8191, 16_400) == ids[8191:16_400]).all() and len(file.ids(3, 3)) == 0


def test_literal_added_tokens(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    end = "<|endoftext|>"
    texts = [f"see {end} here", end, end * 3, f"a {end}{end} b\n ", f"  {end}\n\n{end} x  ", f"w{end}w", "<|endoftext |> <|endoftext", f"one two {end}", "see here", ""]
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert want[0] == [3826, 220, 50256, 994]
    encode = tokens.Encoder(path)
    assert [i.tolist() for i in encode(texts)] == want == [i.tolist() for t in texts for i in encode([t])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sorted(tokens.read_ids(tokens.write_ids(df, path, 2)).collect())
    ids = [np.array([*w, 2], "<u4") for w in want]
    assert [(r["n_tokens"], r["ids_crc32"]) for r in rows] == [(len(i), zlib.crc32(i.tobytes())) for i in ids]


def test_streaming_viterbi_is_exact():
    e = pieces.Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    for text in ("", "a", "x" * 700, _text(300, 9), "日本語 テスト 😀\x00", "    ", "tail "):
        whole = e.prefix + text.replace(" ", pieces.SPACE) if text else ""
        assert list(e.stream(whole)) == e.encode(text).tolist() == list(e.stream((whole,)))


def test_vectors(spark):
    rows = [(i, [float(i % 7), 1.0, -1.0]) for i in range(60)]
    rows += [(100, None), (101, [1.0, None, 1.0]), (102, [float("nan"), 1.0, 1.0]), (103, [0.0, 0.0, 0.0]), (None, [1.0, 1.0, 1.0]), (104, []), (105, [1.0, 2.0]), (7, [0.0, 1.0, -1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    near = neighbours.nearest_neighbours(df, df.filter("vec_id in (14, 100, 103, 105)"), 3).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in sorted(near, key=lambda r: r["rank"])] == [
        (14, 1, 0, 0.0), (14, 2, 7, 0.0), (14, 3, 21, 0.0)]
    top = mtree.top_products(df, df.filter("vec_id in (13, 100, 105)"), 3).collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in sorted(top, key=lambda r: r["rank"])] == [
        (1, 6, 38 * 65536), (2, 20, 38 * 65536), (3, 27, 38 * 65536)]


def test_neighbours_keep_their_recall_with_many_projections(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "cells", lambda rows: 13)  # as for 50 million rows
    x = np.random.default_rng(3).normal(size=(1500, 64))
    x /= np.sqrt((x**2).sum(1))[:, None]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = {}
    for r in neighbours.nearest_neighbours(df, df.filter("vec_id % 30 = 0"), 10).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    want = {q: set(np.argsort(((x - x[q]) ** 2).sum(1))[1:11].tolist()) for q in range(0, 1500, 30)}
    assert sum(len(found[q] & want[q]) for q in want if q in found) >= 0.9 * 10 * len(want)


def test_far_queries_get_all_their_neighbours(spark):
    x = np.random.default_rng(5).normal(size=(600, 64))
    x /= np.sqrt((x**2).sum(1))[:, None]
    x[:12] *= np.arange(4, 28, 2)[:, None]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000 + i, [10.0**i, -(10.0**i)]) for i in range(5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {}
    for r in neighbours.nearest_neighbours(df, df.filter("vec_id < 12 OR vec_id >= 1000"), 10).collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = r["vec_id"]
    assert {q: len(v) for q, v in found.items()} == dict.fromkeys(range(12), 10) | dict.fromkeys(range(1000, 1005), 4)
    for q in (11, 1004):  # beyond reach of the rest
        n = 10 if q < 12 else 4
        near = x if q < 12 else np.array([v for i, v in rows[600:]])
        away = ((near - near[q % 1000]) ** 2).sum(1)
        assert [found[q][k] for k in range(1, n + 1)] == (np.argsort(away)[1 : n + 1] + q // 1000 * 1000).tolist()


def test_products_of_large_components(spark):
    x = np.random.default_rng(7).normal(size=(400, 6)).tolist()
    large = [[1e6, 2.0, 0.0, 0.0, 0.0, 1.0], [-1e6, 0.5, 0.0, 1.0, 0.0, 0.0], [524288.0, 0.0, 1.0, 0.0, 0.0, 0.0], [0.0, -4e12, 0.0, 0.0, 0.0, 3.0], [0.0, 3e12, 0.0, 1.0, 0.0, 0.0]]
    rows = [*enumerate(x), *[(1000 + i, v) for i, v in enumerate(large)]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = {i: [math.floor(256 * c) for c in v] for i, v in rows}
    asked = [0, 50, 1000, 1001, 1002, 1003]
    found = {}
    for r in mtree.top_products(df, df.filter(df.vec_id.isin(asked)), 4).collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    for q in asked:
        scores = sorted((-sum(a * b for a, b in zip(whole[q], v, strict=True)), i) for i, v in whole.items() if i != q)[:4]
        assert [found[q][k] for k in range(1, 5)] == [(i, -s) for s, i in scores]


@pytest.mark.parametrize("most", [0.5, 2.5, 4.0])
def test_mix_takes_as_many_passes_as_asked(spark, most):
    rows = [(i, "w " * (1 + i % 7), "ab"[i % 2]) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = mixing.taken_per_document(mixing.mix(df, share=most, most=most)).collect()
    assert len(taken) == 40
    for s in "ab":
        own = [r for r in taken if r["source"] == s]
        assert sum(r["taken"] for r in own) == math.floor(own[0]["target"]) == math.floor(most * sum(r["size"] for r in own))


def test_merkle(spark):
    a = [(k * 1000, f"d{k}") for k in range(300)]
    b = [r for r in a if r[0] != 5000] + [(5500, "more")]
    b[40] = (b[40][0], "other")
    one, two = (spark.createDataFrame(x, "address long, digest string") for x in (a, b))
    found = sorted((r["address"], r["kind"]) for r in warc.audit(one, two).collect())
    assert found == sorted([(5000, "missing"), (5500, "extra"), (b[40][0], "altered")])
    assert warc.audit(one, one).count() == 0


def test_large_alike_group(spark):
    """Near copies beyond one node's and one block's size keep all their links."""
    base = _text(300, 5).split()
    rows = [(i, " ".join([*base[:150], f"w{i}", *base[150:]])) for i in range(700)]
    found = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["class_id"] for r in found} == {0} and {r["n_links"] for r in found} == {699}


def test_source_mix_shares_the_rest_among_repeated_rows(spark):
    """Sixty equal rows of a small source, and a large one that the mix takes less of; columns with names of our own."""
    columns = "doc_id long, text string, lang string, source string, n_chars long, _words long, _times string, _copies int, _rows int, _doc_id int"
    small = [(7, "ten words " * 5, "en", "a", 50, 1, "x", 2, 3, 4)] * 60
    large = [(100 + k, "some other words here " * 20, "en", "b", 440, 1, "x", 2, 3, 4) for k in range(20)]
    odd = [(7, "ten other " * 5, "en", "a", 50, 1, "x", 2, 3, 4), (None, None, None, None, None, None, None, None, None, None)]
    docs = spark.createDataFrame(small + large + odd, columns)
    taken = {}
    for r in mixing.taken_per_document(mixing.mix(docs)).collect():
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    kept = corpus_pipeline.source_mix(spark, docs, "")
    assert kept.columns == docs.columns
    words = {}
    for r in kept.collect():
        words[r["source"]] = words.get(r["source"], 0) + len((r["text"] or "").split())
    assert abs(words["a"] - taken["a"]) <= 10 and words[None] == 0
    assert corpus_pipeline.source_mix(spark, docs.limit(0), "").count() == 0


def test_archives_of_large_records(spark):
    """Records of 5 MB: files are cut by bytes, and an offset that its address cannot hold is an error."""
    assert warc.files_for(512, 512 * 5_000_000) == 10 and warc.files_for(0, 0) == 1 and warc.files_for(5000, 10**6) == 10
    sizes = [(k, 5_000_000, f"{k:064x}", f"{k * 8_388_608:08x}0000") for k in range(512)]
    records = spark.createDataFrame(sizes, "page_id long, length long, digest string, _place string")
    placed = warc.addressed(records, warc.files_for(512, 512 * 5_000_000)).collect()
    assert max(r["offset"] for r in placed) < 1 << 28 and len({r["address"] for r in placed}) == 512
    with pytest.raises(Exception, match="ask for more files"):
        warc.addressed(records, 1).collect()


def test_archives_of_odd_pages(spark):
    rows = [(1, "u", "é" * 300_000, 0), (1, "u", "é" * 300_000, 1), (None, None, None, 2), (2, "", "", 3), (3, "u", "x" * 3_000_000, 4)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, address int")
    record = warc.warc_record(F.col("url"), F.col("html"))
    place = F.md5(F.concat_ws("|", F.col("page_id").cast("string"), "url"))
    records = pages.select("page_id", F.octet_length(record).cast("long").alias("length"), warc.digest(record).alias("digest"), place.alias("_place"))
    leaves = warc.addressed(records, 2).select("address", "digest")
    assert leaves.count() == 5 and warc.audit(leaves, leaves).count() == 0
    changed = leaves.withColumn("digest", F.when(F.col("digest") == leaves.first()["digest"], F.lit("0")).otherwise(F.col("digest")))
    assert {r["kind"] for r in warc.audit(leaves, changed).collect()} == {"altered"}


def test_queries_that_hashing_does_not_serve_are_bounded(spark):
    rows = [(k, [float(k % 3), float(k)]) for k in range(9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert neighbours.nearest_neighbours(df, df.limit(2), 20).count() == 7  # the zero vector takes no part
    with pytest.raises(ValueError, match="pass pairs="):
        neighbours.nearest_neighbours(df, df.limit(2), 20, pairs=5)


def test_language_equals_plain_compression(spark):
    """Each text against each language's dictionary, one at a time."""
    import zstandard

    rows = [(k, _text(40, k) if k % 2 else "the quick brown fox jumps over it " * 6, "xx" if k % 2 else "en", "s") for k in range(60)]
    rows += [(100, None, "en", "s"), (101, "1234 !", "xx", "s"), (102, "", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    known = language.trained(df)
    found = {r["doc_id"]: (r["lang_pred"], r["score"], r["rejected"]) for r in language.predict(df, known).collect()}
    for doc_id, text, _, _ in rows:
        plain = language.cleaned(text or "").strip()
        if not plain:
            assert found[doc_id] == (language.UNKNOWN, 0.0, True)
            continue
        data, sizes = plain.encode(), {}
        for name, content in sorted(known.items()):
            words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            coder = zstandard.ZstdCompressor(
                dict_data=words, level=language.LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False
            )
            sizes[name] = sum(len(coder.compress(data[i : i + language.CHUNK])) for i in range(0, len(data), language.CHUNK))
        best, second = sorted(sizes.values())[:2]
        margin = (second - best) / second
        assert found[doc_id] == (min(sizes, key=sizes.get), margin, margin < language.NARROW)
