import hashlib
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from halocline.llm import bpe, fit, packing, tokens
from halocline.llm.shared import read

SF = "/root/testdata/sf0.001"
ODD = [None, "", "   \n\t ", "a", "a b", "Ärger ß İ ŉ", "<|endoftext|> x<|endoftext|>", "\x00\x02\x1c \x85\xa0 é́ 日本語 ½ x² _a_",
       "x" * 3000, "word " * 4000, "I'LL 'll it's \U0001f600"]


@pytest.fixture(scope="module")
def public():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def texts():
    return ODD + pd.read_parquet(f"{SF}/documents.parquet")["text"].tolist()


def test_ids_equal_the_public_library(public, texts):
    own = bpe.load()
    for t in texts:
        ids = public.encode(t or "", add_special_tokens=False).ids
        assert own.encode(t) == ids
        assert own.decode(ids) == public.decode(ids, skip_special_tokens=False)
        assert tokens.token_ids(t or "").tolist() == [*ids, 0]


def test_memory_turns_over(texts):
    small = bpe.Bpe(public_tokenizers.path("byte_bpe_50k.json"))
    small.MOST = 6
    for t in texts[:40]:
        assert small.encode(t) == bpe.load().encode(t)


def test_pieces_of_a_long_text(public, monkeypatch):
    monkeypatch.setattr(bpe, "PIECE_WORDS", 50)
    text = "some words, of 12 kinds\n\n  é " * 400
    assert bpe.load().encode(text) == public.encode(text, add_special_tokens=False).ids


def test_digests(spark, make_docs, public):
    df = make_docs([(i, t) for i, t in enumerate(ODD)] + [(1, "again"), (1, "again"), (None, "no id")])
    got = bpe.digests(df).toPandas()
    assert len(got) == len(ODD) + 3
    for i, t in enumerate(ODD):
        ids = public.encode(t or "", add_special_tokens=False).ids
        r = got[(got.doc_id == i)].iloc[0]
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    assert bpe.digests(df.limit(0)).count() == 0
    back = bpe.decode_documents(bpe.encode_documents(df.where("doc_id < 8"))).toPandas().set_index("doc_id")
    assert back.loc[5, "text"] == ODD[5] and back.loc[0, "text"] == ""


def test_capacity_tree_is_best_fit():
    rng = np.random.default_rng(1)
    tree, free = packing.CapacityTree(64), []
    for i in range(400):
        if rng.random() < 0.5:
            c = int(rng.integers(0, 65))
            tree.put(i, c)
            free.append(c)
        else:
            want = int(rng.integers(1, 65))
            fit_ = [c for c in free if c >= want]
            got = tree.take(want)
            assert (got is None) == (not fit_)
            if got:
                assert got[1] == min(fit_)
                free.remove(got[1])


def check_packing(spark, rows, ids_of, capacity):
    """rows: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    for doc, own in rows.groupby("doc_id"):
        own = own.sort_values("piece")
        ids = ids_of[doc]
        assert own.piece.tolist() == list(range(len(own))) and own.length.sum() == len(ids)
        at = 0
        for i, r in enumerate(own.itertuples()):
            assert r.start == at and (r.length == capacity or i == 0)
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].astype("<u4").tobytes())
            at += r.length
        assert len(own) == -(-len(ids) // capacity)
    for _, own in rows.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert own.offset.tolist() == [0, *own.length.cumsum().tolist()[:-1]] and own.length.sum() <= capacity


@pytest.mark.parametrize(("last", "rows_in_range"), [(50_000, 200_000), (10, 40)])
def test_best_fit(spark, make_docs, monkeypatch, last, rows_in_range):
    monkeypatch.setattr(fit, "LAST", last)
    monkeypatch.setattr(fit, "RANGE_ROWS", rows_in_range)
    texts = ODD + pd.read_parquet(f"{SF}/documents.parquet")["text"].tolist()
    df = make_docs(list(enumerate(texts)))
    got = fit.packed(df, capacity=512).toPandas()
    check_packing(spark, got, {i: tokens.token_ids(t or "") for i, t in enumerate(texts)}, 512)
    least = -(-got.length.sum() // 512)
    assert got.sequence_id.nunique() <= 1.03 * least + 2


def test_best_fit_edges(spark, make_docs):
    assert fit.packed(make_docs([])).count() == 0
    got = fit.packed(make_docs([(1, None), (1, None), (None, "a")])).toPandas()
    assert len(got) == 3 and got.sequence_id.nunique() == 1 and sorted(got.offset) == [0, *sorted(got.offset)[1:]]


def test_equal_lengths_in_rounds(spark, make_docs, monkeypatch):
    monkeypatch.setattr(fit, "LAST", 5)
    monkeypatch.setattr(fit, "RANGE_ROWS", 30)
    got = fit.packed(make_docs([(i, "a b c") for i in range(300)]), capacity=16).toPandas()
    assert 75 <= got.sequence_id.nunique() <= 80 and got.groupby("sequence_id").length.sum().max() == 16


def test_packed_matrices(spark, tmp_path):
    docs = read(spark, SF, "documents")
    packed = packing.packed_rows(docs, capacity=256)
    rows = packed.toPandas()
    found: dict[int, dict[int, np.ndarray]] = {}
    for r in rows.itertuples():
        ids = np.frombuffer(r.input_ids, "<u4")
        assert list(r.cu_seqlens)[:-1] == list(r.position_resets) and r.cu_seqlens[-1] == len(ids) == r.n_tokens <= 256
        for d, s, a, b in zip(r.doc_ids, r.starts, r.cu_seqlens[:-1], r.cu_seqlens[1:], strict=True):
            found.setdefault(d, {})[s] = ids[a:b]
    for r in docs.toPandas().itertuples():
        assert np.concatenate([v for _, v in sorted(found[r.doc_id].items())]).tolist() == tokens.token_ids(r.text or "").tolist()
    assert len(rows) <= 1.02 * rows.n_tokens.sum() / 256 + 2
    packing.write_matrices(packed, str(tmp_path / "m"), 256, rows=7)
    back = packing.read_matrices(spark, str(tmp_path / "m")).toPandas().set_index("sequence_id")
    assert len(back) == len(rows)
    for r in rows.itertuples():
        b = back.loc[r.sequence_id]
        assert b.ids_crc32 == zlib.crc32(r.input_ids) and b.n_tokens == r.n_tokens and list(b.doc_ids) == list(r.doc_ids)
        assert list(b.cu_seqlens) == list(r.cu_seqlens) and list(b.pieces) == list(r.pieces) and list(b.starts) == list(r.starts)
    got = spark.read.parquet(str(tmp_path / "m")).toPandas()
    assert got.n_rows.sum() == len(rows)
    m = got.iloc[0]
    matrix = np.frombuffer(m.matrix, "<u4").reshape(m.n_rows, m.capacity)
    first = np.frombuffer(rows.set_index("sequence_id").loc[m.first_sequence, "input_ids"], "<u4")
    assert matrix[0, :len(first)].tolist() == first.tolist() and not matrix[0, len(first):].any()
    assert list(m.cu_seqlens[0]) == list(rows.set_index("sequence_id").loc[m.first_sequence, "cu_seqlens"])


def test_packed_edges(spark, make_docs):
    assert packing.packed_rows(make_docs([])).count() == 0
    got = packing.packed_rows(make_docs([(1, None), (1, ""), (None, "a")]).coalesce(1)).toPandas()
    assert len(got) == 1 and got.n_tokens[0] == 4


def test_query_is_whole(spark):
    n = read(spark, SF, "documents").count()
    assert fit.op8_best_fit(spark, SF).select("doc_id").distinct().count() == n
    assert bpe.op5_bpe_round_trip(spark, SF).count() == n
    assert len({d for r in packing.op3_packed_ids(spark, SF).collect() for d in r["doc_ids"]}) == n


def test_matrices_packed_and_written_in_one_worker(spark, make_docs, tmp_path):
    docs = make_docs([(i, f"word {i} " * (i % 9)) for i in range(2000)]).coalesce(1)
    packing.pack_matrices(docs, str(tmp_path / "m"), 32)
    packing.write_matrices(packing.packed_rows(docs, 32), str(tmp_path / "w"), 32)
    one, two = (packing.read_matrices(spark, str(tmp_path / x)).orderBy("sequence_id").collect() for x in "mw")
    assert one == two and len(one) > 256
    assert spark.read.parquet(str(tmp_path / "m")).agg({"n_rows": "max"}).first()[0] <= 64
