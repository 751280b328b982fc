"""BPE against the tokenizers library."""

import random
from collections import Counter

import numpy as np
import pytest
from millrace.llm import bpe
from millrace.llm.queries import tokenizer_file
from tokenizers import Tokenizer

PATH = tokenizer_file("byte_bpe_50k.json")
FRAGMENTS = [
    "'s", "'re", "'", "''", " ", "  ", "\n", "\n\n", "\t", "a", "st", "the", " the", "12", "½", "é", "日本", "😀", "<|endoftext|>",
    "<|endof", "!", "...", " ", "　", "'ll", "'S", "x'd", "​", "\r\n", "don't", "_", "\0",
]
ALPHABETS = ["a", "ab", "abc", "aeiou", "abcdefghijklmnopqrstuvwxyz", "éè", "日本語中文", "!", "=-", "0123456789", "acgt", " "]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, texts):
    return [e.ids for e in library.encode_batch(list(texts), add_special_tokens=False)]


def encoded(texts):
    counts, _, sizes, ids = bpe.vocabulary(PATH).encoded(list(texts))
    ends = np.r_[0, np.cumsum(sizes)][np.r_[0, np.cumsum(counts)]]
    return [ids[a:b].tolist() for a, b in zip(ends, ends[1:])]


def mixed(seed, n, longest):
    r = random.Random(seed)
    return ["".join(r.choice(FRAGMENTS) for _ in range(r.randint(0, longest))) for _ in range(n)]


def unsplit(seed, n, longest):
    r = random.Random(seed)
    return ["".join(r.choices(r.choice(ALPHABETS), k=r.randint(1, longest))) for _ in range(n)]


def test_texts_of_all_kinds(library):
    texts = mixed(1, 3000, 30)
    assert encoded(texts) == ids_of(library, texts)


def test_text_that_nothing_splits(library):
    texts = [*unsplit(2, 300, 2000), "lorem" * 500, "abcab" * 333, "a" * 4097, "ha" * 2222, " " * 500 + "x", "x" * bpe.LEAF_BYTES]
    assert encoded(texts) == ids_of(library, texts)


def test_characters_are_split_as_in_the_library(library):
    points = [c for c in [*range(0x3400), *range(0x3400, 0x20000, 5), *range(0x20000, 0x110000, 997)] if not 0xD800 <= c < 0xE000]
    for lo in range(0, len(points), 100_000):
        text = "".join(f"a{chr(c)}1{chr(c)}!{chr(c)} {chr(c)}x\n" for c in points[lo : lo + 100_000])
        want = [begin for _, (begin, _) in library.pre_tokenizer.pre_tokenize_str(text)]
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        assert bpe.part_starts(codes, np.array([0])).tolist() == want


def test_tokens_encode_to_themselves():
    # the windows around joins rely on it
    words = bpe.vocabulary(PATH)
    tokens = [i for i in words.bytes_of if i not in words.specials.values()]
    assert [x.tolist() for x in words.merged([words.bytes_of[i] for i in tokens])] == [[i] for i in tokens]


def test_windows_grow_until_both_sides_agree(library, monkeypatch):
    monkeypatch.setattr(bpe, "WINDOW", 1)
    monkeypatch.setattr(bpe, "LEAF_BYTES", 3)
    words, texts = bpe.Vocabulary(PATH), unsplit(3, 200, 400)
    coded = [words.tree(t.encode()).tolist() if t.strip() else None for t in texts]
    want = ids_of(library, texts)
    assert all(c is None or c == w for c, w in zip(coded, want))


@pytest.mark.parametrize("piece_chars", [1, 7, 40, 1 << 16])
def test_pieces_of_any_length(spark, docs, library, piece_chars):
    texts = mixed(4, 60, 60) + unsplit(5, 20, 300)
    out = {r.doc_id: bytes(r.ids) for r in bpe.encode(docs(enumerate(texts)), "doc_id", "text", PATH, piece_chars=piece_chars).collect()}
    assert out == {i: np.array(ids, "<u4").tobytes() for i, ids in enumerate(ids_of(library, texts))}


def test_a_very_long_text(spark, docs, library):
    r = random.Random(6)
    texts = ["".join(r.choices("abcdefghij", k=300_000)), " ".join(mixed(7, 4000, 20)), "x" * 200_000]
    out = bpe.decode(bpe.encode(docs(enumerate(texts)), "doc_id", "text", PATH), PATH).collect()
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in out} == dict(enumerate(ids_of(library, texts)))
    assert {r.doc_id: r.decoded for r in out} == dict(enumerate(texts))


def test_nulls_repeats_and_clashing_names(spark):
    rows = [(1, None, "a"), (2, "", "a"), (None, "hi there", "b"), (3, "same", "c"), (3, "same", "c"), (3, "other", "c"), (None, None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string").withColumn("key", df_null()).withColumn("piece", df_null())
    for piece_chars in (1, 1000):
        out = bpe.decode(bpe.encode(df, "doc_id", "text", PATH, piece_chars=piece_chars), PATH).collect()
        assert Counter((r.doc_id, r.decoded) for r in out) == Counter((i, t or "") for i, t, _ in rows)
    empty = bpe.encode(df.limit(0), "doc_id", "text", PATH)
    assert empty.columns == ["doc_id", "ids"] and empty.count() == 0


def df_null():
    from pyspark.sql import functions as F

    return F.lit(None).cast("int")


def test_decoding_as_the_library_does(spark, library):
    r = random.Random(8)
    cells = [[r.randrange(50300) for _ in range(r.randint(0, 12))] for _ in range(500)] + [[50256, 94, 95], [188]]
    df = spark.createDataFrame([(i, bytearray(np.array(c, "<u4").tobytes())) for i, c in enumerate(cells)] + [(-1, None)], "doc_id bigint, ids binary")
    out = {r.doc_id: r.decoded for r in bpe.decode(df, PATH).collect()}
    assert out == {i: library.decode(c, skip_special_tokens=False) for i, c in enumerate(cells)} | {-1: None}


def test_special_tokens_as_plain_text(library):
    text = "a <|endoftext|> b"
    library.encode_special_tokens = True
    want = library.encode(text, add_special_tokens=False).ids
    library.encode_special_tokens = False
    assert bpe.Vocabulary(PATH, specials=False).encoded([text])[3].tolist() == want
