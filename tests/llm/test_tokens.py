import functools
import random
import subprocess
import sys
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tillsight.llm import curve_packing as cp
from tillsight.llm import queries
from tillsight.llm import token_files as tf
from tillsight.llm.tokens import Encoder, _cuttable
from tillsight.session import new_folder

FILES = {"byte": "byte_bpe_50k.json", "word": "word_bpe_49k.json"}
BITS = ["'s", "'S", "'re", "'ll", "'", "''", " ", "  ", "\n", "\t", "a", "Bc", "é", "É", "é", "12", "3", "½", "…", "--", ".", "日本", "😀", " ",
        " ", "İ", "Σ", "ΑΣ", "ß", "\x1c", "\x85", "don't", "'ve'd", "_", "<|endoftext|>", "</w>", "ǅ", "the", " house"]


@functools.cache
def whole(kind):
    t = Tokenizer.from_file(public_tokenizers.path(FILES[kind]))
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def texts(n=400):
    r = random.Random(11)
    return [None, "", " "] + ["".join(r.choice(BITS) for _ in range(r.randrange(1, 30))) for _ in range(n)]


@pytest.mark.parametrize("kind", FILES)
def test_encoder_equals_the_library(kind):
    t = texts(3000)
    for text, ids in zip(t, Encoder(public_tokenizers.path(FILES[kind]), kind).encode(t), strict=True):
        assert ids.tolist() == whole(kind)(text), repr(text)


@pytest.mark.parametrize("kind", FILES)
def test_long_texts_are_cut_without_a_trace(kind, monkeypatch):
    monkeypatch.setattr("tillsight.llm.tokens._SLICE", 50)
    long = "".join(x or "" for x in texts(300))
    assert "".join(_cuttable(long, 50)) == long
    assert np.concatenate(list(Encoder(public_tokenizers.path(FILES[kind]), kind).encode([long]))).tolist() == whole(kind)(long)


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_token_files(spark, make_docs):
    t = texts()
    rows = [(7 * i - 50, x) for i, x in enumerate(t)]
    random.Random(1).shuffle(rows)
    folder = new_folder(spark, "tokens")
    tf.write_tokens(make_docs(rows + [rows[0]]), folder, public_tokenizers.path(FILES["byte"]))
    back = tf.read_tokens(spark, folder)
    got = tf.checksums(back).orderBy("start").collect()
    start, encode = 0, whole("byte")
    for x, (d, text) in zip(got, sorted(rows + [rows[0]], key=lambda r: r[0]), strict=True):
        ids = [*encode(text), 2]
        assert (x.doc_id, x.start, x.n_tokens, x.ids_crc32) == (d, start, len(ids), crc(ids))
        start += len(ids)
    plan = back.where("doc_id = 13")._jdf.queryExecution().toString()
    assert "EqualTo(doc_id,13)" in plan
    assert back.where("doc_id = 13").count() == 1


def test_token_files_with_null_ids_and_empty_tables(spark, make_docs):
    for rows, n in (([], 0), ([(None, "a"), (None, None), (1, "b")], 3)):
        folder = new_folder(spark, "tokens")
        tf.write_tokens(make_docs(rows), folder, public_tokenizers.path(FILES["byte"]))
        assert tf.checksums(tf.read_tokens(spark, folder)).count() == n


def test_hilbert_is_a_walk_of_neighbours():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.indices([1 << bits] * dims).reshape(dims, -1).T
        keys = cp.hilbert(cells, bits)
        assert sorted(keys.tolist()) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_packing_is_a_round_trip(spark, make_docs):
    t = texts() + ["long " * 9000, "word " * 2047]
    rows = list(enumerate(t)) + [(5, t[5]), (None, "null id")]
    pieces = cp.packed(make_docs(rows), public_tokenizers.path(FILES["word"])).collect()
    sequences, found, encode = defaultdict(list), defaultdict(list), whole("word")
    for p in pieces:
        assert p.length == len(p.ids) > 0 and p.ids_crc32 == crc(p.ids)
        sequences[p.sequence_id].append(p)
        found[p.doc_id].append(p)
    for s in sequences.values():
        at = 0
        for p in sorted(s, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048 and at & (at - 1) == 0
    for d, text in rows:
        ids = [*encode(text), 1]
        own = sorted(found[d], key=lambda p: p.start)
        if d != 5:
            assert [i for p in own for i in p.ids] == ids and all(p.doc_tokens == len(ids) for p in own)
    assert cp.packed(make_docs([]), public_tokenizers.path(FILES["word"])).count() == 0


SPECIAL = [*BITS, "<|endoftext|>", "<|startoftext|>", "<|endoftext|><|endoftext|>", "<|endof", "<|ENDOFTEXT|>", "<<|endoftext|>>"]


def special_texts(n=2000):
    r = random.Random(12)
    return [None, "", "<|endoftext|>", " <|endoftext|>"] + ["".join(r.choice(SPECIAL) for _ in range(r.randrange(1, 20))) for _ in range(n)]


@pytest.mark.parametrize("kind", FILES)
@pytest.mark.parametrize("size", [50, 1_500_000])
def test_special_tokens_equal_the_untouched_library(kind, size, monkeypatch):
    monkeypatch.setattr("tillsight.llm.tokens._SLICE", size)
    plain = Tokenizer.from_file(public_tokenizers.path(FILES[kind]))
    t = special_texts()
    t.append("".join(x or "" for x in t[:300]))
    for text, ids in zip(t, Encoder(public_tokenizers.path(FILES[kind]), kind, special=True).encode(t), strict=True):
        assert ids.dtype == np.int32 and ids.tolist() == plain.encode(text or "", add_special_tokens=False).ids, repr(text)[:200]


def test_queries_encode_special_tokens(spark, make_docs, tmp_path):
    t = special_texts(40)
    make_docs(list(enumerate(t))).drop("k1", "words").write.parquet(f"{tmp_path}/documents.parquet")
    for f, kind, end in ((queries.op2, "byte", 2), (queries.op9, "word", 1)):
        plain = Tokenizer.from_file(public_tokenizers.path(FILES[kind]))
        want = {i: len(plain.encode(x or "", add_special_tokens=False).ids) + 1 for i, x in enumerate(t)}
        got = f(spark, str(tmp_path)).collect()
        assert {x.doc_id: x.n_tokens if kind == "byte" else x.doc_tokens for x in got} == want
        if kind == "byte":
            assert {x.doc_id: x.ids_crc32 for x in got} == {
                i: crc([*plain.encode(x or "", add_special_tokens=False).ids, end]) for i, x in enumerate(t)}


def test_new_words_do_not_take_an_encoding_each():
    """A worker's memory while it learns a slice of new words alone: measured in a process of its own."""
    code = """
import random, public_tokenizers
from tillsight.llm.tokens import Encoder
peak = lambda: next(int(line.split()[1]) // 1024 for line in open("/proc/self/status") if line.startswith("VmHWM"))
r = random.Random(1)
e = Encoder(public_tokenizers.path("byte_bpe_50k.json"), "byte")
list(e.encode(["a b " * 240_000]))
before = peak()
list(e.encode([" ".join("".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=5)) for _ in range(160_000))]))
print(peak() - before)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=Path(__file__).parents[2])
    assert int(out.stdout.split()[-1]) < 70
