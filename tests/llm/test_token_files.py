import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from tokenizers import Tokenizer

from viewtide.llm import token_files
from viewtide.llm.queries import queries

HARD = [
    "Hello, World! It's <|endoftext|> fine<|startoftext|>x  don't stop", "ÅNGSTRÖM é ́x İstanbul ΣΑΣ ﬁ",
    "a\x0bb\x0cc\x1cd e　f\x85g", "", None, " \n\t ", "日本語 テキスト 123 4,5", "​ zero‍width 👩‍👩‍👧", "the " * 30_000,
    "<|endoftext|> <|ENDOFTEXT|>", "'s 't ' s", "﻿bom ퟿",
]


def brute(rows):
    model = Tokenizer.from_file(token_files.default_tokenizer())
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        ids = [*model.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query(spark, duck, sf):
    got = sorted(map(tuple, queries()["op9_token_files"](spark, sf).collect()))
    assert got == brute(duck.sql("select doc_id, text from documents").fetchall())


def test_hard_texts(documents):
    rows = [(k * 7 % len(HARD), text, "s") for k, text in enumerate(HARD)] + [(None, "no id", "s")]
    got = token_files.write_and_read(documents(rows)).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == brute([r[:2] for r in rows])


def test_words_of_any_kind():
    """Random words of letters, marks, digits, punctuation and special tokens, as the tokenizer alone encodes them."""
    rng, model = random.Random(2), Tokenizer.from_file(token_files.default_tokenizer())
    encode = token_files.encoder(token_files.default_tokenizer())
    for words, whole in ((["a1", "It's", "dogs'", "X,", "3.5", "'", "A!b?", "İ.", "aİ!"], [0, 2, 4, 5, 7, 8]),
                         (["<|ENDOFTEXT|>1", "b<|ENDOFTEXT|>a.", "b."], [0, 1]), (["é.", "B", ""], [2])):
        stems, ends = token_files._stems_and_ends(pa.array(words), ["<|endoftext|>"])
        assert [(s + e).lower() for s, e in zip(stems.to_pylist(), ends.to_pylist())] == [w.lower() for w in words]
        assert all(stems[k].as_py() == words[k] for k in whole)
    signs = [*"abzABZéÉñÑßİıΣσςǰŉ½²Ⅷ日각ـ١", "\u0301", "\u0331", "\u0338", "\u200d", *"'.,!?;:%&#$<|>_-()[]{}`~^@/\\+*=\"019",
             "'s", "'ll", "<|endoftext|>", "<|"]
    for _ in range(300):
        text = " ".join("".join(rng.choice(signs) for _ in range(rng.randrange(1, 7))) for _ in range(40))
        assert encode(pa.array([text]))[0].as_py() == model.encode(text, add_special_tokens=False).ids, text


def test_forgotten_stems(monkeypatch):
    """Ids stay right when stems are forgotten, and over slices of a column."""
    monkeypatch.setattr(token_files, "CACHED_STEMS", 30)
    model = Tokenizer.from_file(token_files.default_tokenizer())
    encode = token_files._make_encoder(token_files.default_tokenizer())
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcdefgh") * rng.randrange(1, 9) + rng.choice(["", ",", "."]) for _ in range(rng.randrange(20)))
             for _ in range(120)]
    for at in range(0, 120, 40):
        got = encode(pa.array(texts).slice(at, 40)).to_pylist()
        assert got == [model.encode(text, add_special_tokens=False).ids for text in texts[at : at + 40]]


def test_repeated_and_empty(documents):
    rows = [(1, "a b c", "s")] * 3 + [(2, "d", "s")]
    got = sorted(map(tuple, token_files.write_and_read(documents(rows)).collect()))
    assert [r[1] for r in got] == [0, 4, 8, 12]
    assert token_files.write_and_read(documents([])).collect() == []


def test_files(spark, documents, tmp_path):
    rows = [(k, f"word{k} the and of", "s") for k in range(5000)]
    path = str(tmp_path / "tokens")
    token_files.write(documents(rows), path, metadata=("source",))
    parts = sorted(tmp_path.glob("tokens/part-*"))
    last = -1
    for part in parts:
        meta = pq.ParquetFile(part).metadata
        chunks = {meta.row_group(0).column(k).path_in_schema: meta.row_group(0).column(k) for k in range(meta.num_columns)}
        assert "RLE_DICTIONARY" in chunks["token_ids.list.element"].encodings
        assert "DELTA_BINARY_PACKED" in chunks["doc_id"].encodings
        assert chunks["doc_id"].has_column_index and chunks["doc_id"].has_offset_index
        assert chunks["doc_id"].statistics.min > last
        last = chunks["doc_id"].statistics.max
    some = token_files.read(spark, path, 100, 105)
    assert sorted(r.doc_id for r in some.collect()) == list(range(100, 106))
    plan = some.select("doc_id", "start")._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(doc_id,100)" in plan and "token_ids:array" not in plan.split("Physical Plan")[1]
