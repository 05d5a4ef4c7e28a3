"""Registered queries against SQL or brute force over the small tables."""

import sys
import zlib
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import corpus_pipeline
import public_tokenizers
from brute import covered, jaccard_classes
from oracle import connect, differences

from trendstrata.llm import jaccard, language, mixing, pieces, suffixes
from trendstrata.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) == []


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    return [r.asDict() for r in rows]


def test_sentencepiece(spark, sf_dir, documents):
    import hashlib

    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as proto

    # The library's own unigram encoder over the same pieces; the two scores
    # of a billion would drown the others in its 32-bit sums.
    model = proto.ModelProto()
    model.ParseFromString(Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes())
    model.trainer_spec.model_type = 1
    for piece in model.pieces:
        piece.score = max(piece.score, -40_000)
    library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    found = {r["doc_id"]: r for r in QUERIES["op3_sentencepiece"](spark, sf_dir).collect()}
    assert len(found) == len(documents)
    for d in documents:
        row, text = found[d["doc_id"]], d["text"] or ""
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        if len(text) < 1500:
            assert row["ids"] == library.encode(text)


def _plain_viterbi(model, text):
    """Best segmentation of a whole text with all positions at hand."""
    text = model.prefix + text.replace(" ", pieces.SPACE)
    best, back = [0.0] + [-np.inf] * len(text), [0] * (len(text) + 1)
    for at in range(len(text)):
        for end in range(at + 1, min(at + model.longest, len(text)) + 1):
            known = model.scores.get(text[at:end])
            score = known[0] if known else model.worst if end == at + 1 else None
            if score is not None and best[at] + score > best[end]:
                best[end], back[end] = best[at] + score, at
    cuts = [len(text)]
    while cuts[-1]:
        cuts.append(back[cuts[-1]])
    cuts.reverse()
    return [i for a, b in zip(cuts, cuts[1:], strict=False) for i in model._ids(text[a:b])]


def test_sentencepiece_of_long_texts(documents):
    """The streaming encoder against a plain one, fed in parts of any size."""
    model = pieces.pieces(public_tokenizers.path("piece_bpe_32k.model"))
    texts = sorted((d["text"] or "" for d in documents), key=len)[-5:]
    odd = ["x" * 5000, "aaaaab" * 900, "é😀" * 700, "   " * 999, "in" + "ter" * 2000 + " nation", "", " "]
    for text in [*texts, *odd]:
        want = _plain_viterbi(model, text) if text else []
        assert model.encode(text).tolist() == want
        whole = model.prefix + text.replace(" ", pieces.SPACE) if text else ""
        for step in (1, 7, 5000):
            assert list(model.stream(whole[k : k + step] for k in range(0, len(whole), step))) == want


def test_the_encoder_holds_little(documents):
    model = pieces.pieces(public_tokenizers.path("piece_bpe_32k.model"))
    for text in ("ab" * 20_000, max((d["text"] or "" for d in documents), key=len), "x" * 20_000):
        machine, most = pieces.Viterbi(model), 0
        for char in text:
            machine.push(char)
            most = max(most, len(machine._text))
        assert most < 20 * model.longest


def test_token_files(spark, sf_dir, documents):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = {r["doc_id"]: r for r in QUERIES["op4_token_files"](spark, sf_dir).collect()}
    start = 0
    for d in documents:
        ids = np.array([*plain.encode(d["text"] or "", add_special_tokens=False).ids, 2], "<u4")
        row = found[d["doc_id"]]
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_language(spark, documents):
    sf_dir = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op5_language"](spark, sf_dir).collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_jaccard(spark, sf_dir, documents):
    want = jaccard_classes([(d["doc_id"], d["text"]) for d in documents])
    rows = QUERIES["op6_jaccard"](spark, sf_dir).collect()
    assert len(rows) == len(documents)
    for r in rows:
        assert (r["class_id"], r["n_links"], r["n_copies"]) == want.get(r["doc_id"], (r["doc_id"], 0, 1))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_neighbours(spark, sf):
    sf_dir = f"/root/testdata/{sf}"
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], np.float64)
    hit = total = 0
    found = QUERIES["op7_neighbours"](spark, sf_dir).toPandas()
    for q, own in found.groupby("query_id"):
        away = np.sqrt(((x - x[ids == q]) ** 2).sum(1))
        away[ids == q] = np.inf
        best = ids[np.lexsort((ids, away))[:10]]
        hit, total = hit + len(set(best) & set(own["vec_id"])), total + 10
        own = own.sort_values("rank")
        assert list(own["rank"]) == list(range(1, len(own) + 1))
        assert np.allclose(own["score"], [away[ids == v][0] for v in own["vec_id"]], rtol=1e-14)
        assert (np.diff(own["score"]) >= 0).all()
    assert found["query_id"].nunique() == (ids % 100 == 0).sum()
    assert hit >= 0.9 * total


def test_suffixes(spark, sf_dir, documents):
    want = dict(zip([d["doc_id"] for d in documents], covered([d["text"] for d in documents]), strict=True))
    rows = QUERIES["op9_suffixes"](spark, sf_dir).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows} == want


def test_pipeline(spark, sf_dir, documents):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = corpus_pipeline.language_id(spark, docs, sf_dir)
    assert kept.columns == docs.columns and kept.count() >= 0.97 * len(documents)

    one = corpus_pipeline.near_duplicates(spark, docs, sf_dir)
    want = jaccard_classes([(d["doc_id"], d["text"]) for d in documents])
    classes = {want.get(d["doc_id"], (d["doc_id"],))[0] for d in documents}
    assert one.columns == docs.columns and sorted(r["doc_id"] for r in one.collect()) == sorted(classes)

    cut = corpus_pipeline.repeated_passages(spark, docs, sf_dir)
    removed = {d["doc_id"]: c[1] for d, c in zip(documents, covered([d["text"] for d in documents]), strict=True)}
    assert cut.columns == docs.columns
    for r in cut.collect():
        lost = len((next(d["text"] for d in documents if d["doc_id"] == r["doc_id"]) or "").encode()) - len((r["text"] or "").encode())
        assert removed[r["doc_id"]] <= lost <= removed[r["doc_id"]] + 6 * (removed[r["doc_id"]] > 0)

    mixed = corpus_pipeline.source_mix(spark, docs, sf_dir)
    taken = {r["doc_id"]: r for r in mixing.op8_mixing(spark, sf_dir).collect()}
    times = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert mixed.columns == docs.columns
    assert all(abs(times.get(i, 0) - r["taken"] / r["size"]) <= 0.5 for i, r in taken.items() if r["size"])

    assert corpus_pipeline.run(spark, sf_dir).columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"]


def test_pipeline_keeps_short_texts(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    short = {r["doc_id"] for r in docs.filter("lang IS NOT NULL AND length(text) < 200 AND text RLIKE '[A-Za-z]'").collect()}
    kept = {r["doc_id"] for r in corpus_pipeline.language_id(spark, docs, sf_dir).select("doc_id").collect()}
    assert short and short <= kept


def test_modules_are_the_ones_tested():
    assert jaccard.runs_for() >= 5 and suffixes.LENGTH == 200 and language.UNKNOWN == "und"
