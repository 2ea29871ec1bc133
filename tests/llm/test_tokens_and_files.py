import io
import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from helpers import documents

from querytrail.llm import idcoder, idfiles, tokens
from querytrail.llm.common import byte_columns
from querytrail.llm.queries import tokenizer_file
from querytrail.llm.tokens import END_ID, encoder

FILE = tokenizer_file("word_bpe_49k.json")


def library_ids(text):
    return [*encoder(FILE).tokenizer.encode(text or "", add_special_tokens=False).ids, END_ID]


def test_encoder_equals_the_library():
    rng = random.Random(0)
    letters = "ab'sStTmdrevl  \n\t.,!0129²½ªµºßÀÖ×ØÞàö÷øÿ\x85\xa0\x0b\x0c\x1c\x1f\x00\x7f\x80«»¿<|Éé"
    some = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    some += ["", None, "<|endoftext|> x", "日本 語's", "it's they're we'll I'D 'sum 'll''s", "İstanbul ΣΑΣ é ﬁ", "a" * 70000, "x " * 5000]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(some))), pa.array(some)], ["id", "text"])
    enc = encoder(FILE)
    got = []
    for lo, hi, ids, at in enc.batches(*byte_columns(batch)):
        got += [ids[at[i] : at[i + 1]].tolist() for i in range(hi - lo)]
    assert got == [library_ids(t) for t in some]


def test_more_pieces_than_the_table_has_slots(monkeypatch):
    monkeypatch.setattr(tokens, "TABLE_BITS", 4)
    enc = tokens.Encoder(FILE)
    some = ["ab", " ".join(f"{a}x{b}" for a in "abcdefgh" for b in "klmnopqr"), "ab cd", "ef gh ij"]
    for texts in (some, some[:1], some[1:2], some[2:]):
        batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["id", "text"])
        got = [ids[at[i] : at[i + 1]].tolist() for lo, hi, ids, at in enc.batches(*byte_columns(batch)) for i in range(hi - lo)]
        assert got == [library_ids(t) for t in texts]


@pytest.mark.parametrize("blocks,size", [(1, 0), (1, 1), (3, 17), (40, 300), (200, 60)])
def test_coder_round_trip(blocks, size):
    rng = np.random.default_rng(blocks)
    data = [rng.integers(0, 65536 if i % 3 else 6, max(0, size - i)).astype(np.uint16) for i in range(blocks)]
    data.sort(key=len, reverse=True)
    table = idcoder.Table.of(np.concatenate(data))
    payloads = idcoder.encode_blocks(data, table)
    read = idcoder.Table.read(io.BytesIO(table.to_bytes()))
    back = idcoder.decode_blocks(payloads, np.array([len(b) for b in data]), read)
    assert all(len(a) == len(b) and (a == b).all() for a, b in zip(data, back, strict=True))


def test_blocks_are_independent_and_adapt():
    a = np.tile(np.array([5000, 40000, 77, 12], np.uint16), 1000)
    b = np.random.default_rng(1).integers(0, 60000, 4000).astype(np.uint16)
    table = idcoder.Table.of(np.concatenate([a, b]))
    together, alone = idcoder.encode_blocks([a, b], table), idcoder.encode_blocks([a], table)
    assert together[0] == alone[0] and len(alone[0]) < len(a) * 2 // 8


def test_no_bit_is_plain():
    rng = np.random.default_rng(3)
    narrow = rng.integers(20_000, 20_064, 4096).astype(np.uint16)  # 6 bits of 16 are in use
    few = (512 + 64 * rng.integers(0, 2, 4096) + rng.integers(0, 8, 4096)).astype(np.uint16)  # 4 bits of 9
    sizes = [len(idcoder.encode_blocks([x], idcoder.Table.of(x))[0]) * 8 / 4096 for x in (narrow, few)]
    assert sizes[0] < 6.6 and sizes[1] < 4.8


def test_bits_an_id_stay_below_the_entropy_of_text():
    """The documents' ids cost less than a static order-0 table that is free."""
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column(0).to_pylist()
    ids = np.array([i for t in texts for i in library_ids(t)], np.uint16)
    counts = np.bincount(ids)
    share = counts[counts > 0] / len(ids)
    entropy = -(share * np.log2(share)).sum()
    table = idcoder.Table.of(ids)
    blocks = [ids[i : i + 4096] for i in range(0, len(ids), 4096)]
    size = len(table.to_bytes()) + sum(map(len, idcoder.encode_blocks(blocks, table)))
    assert size * 8 / len(ids) < entropy


def test_rare_ids_beside_a_frequent_one():
    """Classes of one id, of very many, and of none."""
    ids = np.r_[np.full(200_000, 9), np.arange(65_536)].astype(np.uint16)
    for part in (ids, ids[:5000], ids[-1:]):
        table = idcoder.Table.of(part)
        assert all(table.width[part] > 0)
        blocks = [part[i : i + 4096] for i in range(0, len(part), 4096)]
        back = idcoder.decode_blocks(idcoder.encode_blocks(blocks, table), np.array([len(b) for b in blocks]), table)
        assert (np.concatenate(back) == part).all()


def id_file(docs):
    out = io.BytesIO()
    writer = idcoder.IdFileWriter(out)
    for i, ids in docs:
        writer.add(np.array([i or 0]), np.array([i is None]), np.array([len(ids)]), np.array(ids, np.uint32))
    writer.close()
    return out


def test_file_round_trip_and_checksums(monkeypatch):
    monkeypatch.setattr(idcoder, "LANES", 3)
    monkeypatch.setattr(idcoder, "BLOCK_IDS", 50)
    rng = np.random.default_rng(2)
    docs = [(i if i != 4 else None, rng.integers(0, 49408, int(rng.integers(1, 400))).tolist()) for i in range(30)]
    out = id_file(docs)
    got = []
    for ids, nulls, lengths, flat in idcoder.read_id_file(out):
        ends = np.cumsum(lengths)
        got += [(None if z else int(d), flat[e - n : e].tolist()) for d, z, n, e in zip(ids, nulls, lengths, ends, strict=True)]
    assert got == docs
    raw = bytearray(out.getvalue())
    for at in (60, len(raw) // 2, len(raw) - 60):  # a table, a block, the index
        raw[at] ^= 1
        with pytest.raises(ValueError):
            list(idcoder.read_id_file(io.BytesIO(bytes(raw))))
        raw[at] ^= 1
    assert list(idcoder.read_id_file(id_file([]))) == []
    with pytest.raises(ValueError, match="16 bits"):
        id_file([(1, [70000])])


def test_query_rows(spark):
    rows = [(i * 3 % 50, f"Document {i}, it's number {i}! " * (i % 7)) for i in range(50)] + [(60, None), (None, "no id"), (61, "日本 x"), (5, "again"), (62, "word " * 20_000)]
    rows.append(rows[3])
    got = idfiles.read_id_files(idfiles.write_id_files(documents(spark, rows).repartition(3), FILE)).collect()
    assert len(got) == len(rows)
    texts = {}
    for i, t in rows:
        texts.setdefault(i, []).append(library_ids(t))
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        ids = next(x for x in texts[r["doc_id"]] if len(x) == r["n_tokens"] and zlib.crc32(np.array(x, "<u4").tobytes()) == r["ids_crc32"])
        at += len(ids)
    order = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    assert idfiles.read_id_files(idfiles.write_id_files(documents(spark, []), FILE)).count() == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_every_installed_file_gives_the_library_s_ids(name):
    from tokenizers import Tokenizer

    path = tokenizer_file(name)
    own, library = tokens.Encoder(path), Tokenizer.from_file(path)
    assert own.split_here == (name == "word_bpe_49k.json")
    rng = np.random.default_rng(11)
    signs = list("aZ é'9 \t\n-.<|>") + ["'s", "the ", "ß", "½", "中"]
    rows = ["".join(rng.choice(signs, rng.integers(0, 60))) for _ in range(300)] + ["<|endoftext|>", ""]
    raw = [r.encode() for r in rows]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.r_[0, np.cumsum([len(r) for r in raw])]
    ids, at = own.encode(data, offsets)
    got = [ids[a : b - 1].tolist() for a, b in zip(at[:-1], at[1:], strict=True)]
    assert got == [library.encode(r, add_special_tokens=False).ids for r in rows]
