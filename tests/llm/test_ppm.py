import math
import zlib
from collections import Counter, defaultdict

import pytest

from viewtide.llm import ppm


def tokens(text):
    return (text or "").encode().lower().split()


def modelled(text):
    return b" ".join(tokens(text)) + b"\n"


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 == 0


def brute(rows, order=ppm.ORDER):
    learned = [t for d, t in rows if not held(d)]
    trie = defaultdict(Counter)
    for text in learned:
        padded = b"\n" * order + modelled(text)
        for at in range(order, len(padded)):
            for k in range(order + 1):
                trie[padded[at - k : at]][padded[at]] += 1

    def price(context, byte):
        p, excluded = 1.0, set()
        for k in range(order, -1, -1):
            found = trie.get(context[len(context) - k :])
            if not found:
                continue
            left = {b: n for b, n in found.items() if b not in excluded}
            total = sum(left.values())
            if byte in left:
                return p * (2 * left[byte] - 1) / (2 * total)
            if left:
                p *= len(left) / (2 * total)
            excluded |= set(found)
        return p / max(1, 256 - len(excluded))

    words = Counter(w for t in learned for w in [*tokens(t), None])
    n, v = sum(words.values()), len(words)
    out = []
    for doc_id, text in rows:
        padded = b"\n" * order + modelled(text)
        own = [words[w] for w in [*tokens(text), None]]
        out.append((
            doc_id, held(doc_id), len(own), sum(c > 0 for c in own), n,
            sum(math.log10((c + 0.1) / (n + 0.1 * (v + 1))) for c in own),
            sum(math.log10(price(padded[at - order : at], padded[at])) for at in range(order, len(padded))),
        ))
    return out


def same(got, expected):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    got, expected = sorted(map(tuple, got), key=key), sorted(expected, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    assert [x for r in got for x in r[5:]] == pytest.approx([x for r in expected for x in r[5:]], rel=1e-5)


def test_cases(documents):
    rows = [
        (1, "The cat sat on the mat.\nThe  cat"), (2, None), (3, " \t"), (None, "a cat"), (5, "É\x0b日本 the MAT"),
        (6, "the the the"), (6, "the the the"), (12, "zzz the new ~ word"), (13, "x" * 3000), (7, "cat"), (10, "dog"),
    ] + [(k, f"word{k % 7} and cat {k}") for k in range(20, 60)]
    same(ppm.score(documents([(*r, "s") for r in rows])).collect(), brute(rows))


def test_small_blocks_and_other_orders(documents, monkeypatch):
    monkeypatch.setattr(ppm, "_BLOCK_BITS", 2)
    rows = [(k, f"line {k * k} of {'abcab'[k % 5] * (k % 9)} text") for k in range(80)]
    for order in (2, 3, 5):
        same(ppm.score(documents([(*r, "s") for r in rows]), order).collect(), brute(rows, order))


def test_nothing_to_learn_from(documents):
    assert ppm.score(documents([])).collect() == []
    doc_id = next(k for k in range(100) if held(k))
    same(ppm.score(documents([(doc_id, "a b", "s")])).collect(), brute([(doc_id, "a b")]))


def test_held_out_documents_are_foreseen_better_than_by_words(spark, sf):
    # So small a corpus has many rare words; longer contexts spell those better.
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = ppm.score(docs, order=6).filter("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)
