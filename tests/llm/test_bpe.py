"""BPE against the tokenizers library, by text and through Spark."""

import hashlib
import json
import random
from pathlib import Path

import pytest
from tokenizers import Tokenizer

from revloom.llm import bpe
from tests.conftest import SF


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.vocabulary_path())


@pytest.fixture(scope="module")
def codec():
    with open(bpe.vocabulary_path(), encoding="utf-8") as file:
        return bpe.Codec(json.load(file))


TEXTS = [
    "",
    " ",
    "a",
    "it's  we'll\n\n  I'M 12.5%\t\r\n x",
    "<|endoftext|>a<|endoftext|><|endoftext|> b<|endoftext",
    "naïve – Größe ½ ٣٤ 漢字かな　 x\u0085y\x1cz \x1d՘",
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa" * 50,
    "=-=-=-" * 700,
    "👩‍👩‍👧‍👦 é ​﻿" * 20,
    "   trailing   ",
]


def same(codec, library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    assert codec.encode(text).tolist() == ids
    assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("text", TEXTS)
def test_chosen_texts(codec, library, text):
    same(codec, library, text)


def test_random_texts(codec, library):
    rng = random.Random(3)
    kinds = ["abcdefgh", " \n\t'", "éßñ漢½²", "0123456789", ".,!#$", "".join(map(chr, range(0x2000, 0x2030)))]
    for _ in range(400):
        text = "".join(rng.choice(rng.choice(kinds)) for _ in range(rng.randrange(80)))
        same(codec, library, text)


def test_every_assigned_kind_of_character(codec, library):
    for start in range(0, 0x30000, 7):
        if not 0xD7F0 <= start <= 0xE000:
            same(codec, library, "a" + chr(start) + " 1" + chr(start) + "." + chr(start))


def test_broken_bytes_decode_with_replacement(codec, library):
    ids = codec.encode("漢字")[:1].tolist()
    assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_query(spark, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = bpe.op3_bpe(spark, SF).collect()
    assert len(rows) == len(docs)
    for row in rows:
        ids = library.encode(docs[row.doc_id], add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        text = library.decode(ids, skip_special_tokens=False)
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_nulls_clashing_names_and_empty_table(spark):
    rows = [(1, None, "x", [9]), (None, "ab", None, None), (3, "", "y", [1]), (3, "", "y", [1])]
    df = spark.createDataFrame(rows, "doc_id long, text string, decoded string, ids array<int>")
    out = bpe.round_trip(df)
    assert out.columns == ["doc_id", "text", "decoded", "ids", "ids_", "decoded_"]
    got = {(r.doc_id, r.decoded, tuple(r.ids_)) for r in out.collect()}
    assert (1, "x", ()) in got and (3, "y", ()) in got and out.count() == 4
    assert bpe.round_trip(df.limit(0)).count() == 0


def test_side_by_side_merges_are_those_of_one_at_a_time(monkeypatch):
    """Random pre-tokens of all widths, many together, against a tree each."""
    codec = bpe.Codec(json.loads(Path(bpe.vocabulary_path()).read_text(encoding="utf-8")))
    rng = random.Random(8)
    parts = {"".join(rng.choice("abthe ingé東1\n") for _ in range(rng.randrange(1, 64))) for _ in range(2000)}
    for leaves in (1, 2, 4, 8, 16, 32, 64):
        own = [p for p in parts if 2 <= len(p.encode()) <= 64 and 1 << (len(p.encode()) - 2).bit_length() == leaves]
        codec._learn_parts(own, leaves + 1)
        assert all(codec.parts[p] == codec._encode_part(p) for p in own)
    # With tables of a few entries, what is lost on the way is encoded again.
    texts = [" ".join(rng.sample(sorted(parts), 20)) for _ in range(30)]
    whole = [x.tolist() for x in codec.encode_all(texts)]
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 5)
    small = bpe.Codec(json.loads(Path(bpe.vocabulary_path()).read_text(encoding="utf-8")))
    assert [x.tolist() for x in small.encode_all(texts)] == whole
