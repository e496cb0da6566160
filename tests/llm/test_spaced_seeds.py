import random
import re

from viewtide.llm import spaced_seeds as ss


def sentence(rng, n):
    return ["".join(rng.choice("abcdefghijklm") for _ in range(7)) for _ in range(n)]


def brute(text, items):
    """Number of distinct items of which some window agrees with the text, at any shift."""
    words = re.findall(r"[a-z0-9]+", (text or "").lower())
    found = 0
    for item in set(items):
        own = re.findall(r"[a-z0-9]+", (item or "").lower())
        width = min(ss.WINDOW, len(own))
        if len(own) < ss.SPAN:
            found += any(words[a : a + len(own)] == own for a in range(len(words) - len(own) + 1)) if own else False
            continue
        found += any(
            sum(x == y for x, y in zip(words[a : a + width], own[b : b + width])) >= ss.SIMILARITY * width
            for a in range(len(words) - width + 1) for b in range(len(own) - width + 1)
        )
    return found


def test_copies_with_substitutions(spark, documents):
    rng = random.Random(5)
    items = [" ".join(sentence(rng, rng.choice([12, 25, 40]))) for _ in range(12)] + ["too short to match", None, ""]
    rows = []
    for k in range(60):
        text = sentence(rng, 60)
        if k % 2:
            copied = items[k % 12].split()
            for place in range(3, len(copied), 9):
                copied[place] = "other"
            text[20:20] = [w.upper() + "," for w in copied]
        rows.append((k, " ".join(text), "s"))
    benchmark = spark.createDataFrame([(i, t) for i, t in enumerate(items + items[:3])], "item_id long, text string")
    got = {r.doc_id: r.n_items for r in ss.mark(documents(rows), benchmark).collect()}
    assert got == {d: brute(t, items) for d, t, _ in rows}
    assert sum(n > 0 for n in got.values()) == 30


def test_cases(spark, documents):
    rng = random.Random(6)
    item = " ".join(sentence(rng, 30))
    long_text = " ".join(sentence(rng, 40_000)) + " " + item
    rows = [(None, item, "s"), (1, None, "s"), (2, "", None), (3, item, "s"), (3, item, "s"), (4, long_text, "s"), (5, "a b", "s")]
    docs = documents(rows)
    benchmark = spark.createDataFrame([(item,)], "text string")
    marked = ss.mark(docs, benchmark)
    assert marked.columns[: len(docs.columns)] == docs.columns
    got = sorted(((r.doc_id, r.n_items) for r in marked.collect()), key=repr)
    assert got == sorted([(None, 1), (1, 0), (2, 0), (3, 1), (3, 1), (4, 1), (5, 0)], key=repr)
    assert ss.mark(docs.limit(0), benchmark).count() == 0
    assert all(r.n_items == 0 for r in ss.mark(docs, benchmark.limit(0)).collect())


def test_items_too_short_for_the_masks(spark, documents):
    """One to nine words: found where all of them stand, in any case and with any punctuation."""
    rng = random.Random(8)
    items = [" ".join(sentence(rng, n)) for n in (*range(1, 10), 3, 9, 30)]
    rows = [(k, " ".join(sentence(rng, 20) + items[k].upper().replace(" ", ", ").split() + sentence(rng, 3 * (k % 2))), "s")
            for k in range(12)]
    almost = items[8].split()
    rows += [(20, " ".join(almost[:8] + ["other"]), "s"), (21, items[0], "s"), (22, f"{items[1]} {items[1]} {items[0]}", "s")]
    rows += [(23, " ".join(items[4].split()[::-1]), "s")]
    benchmark = spark.createDataFrame([(t,) for t in items], "text string")
    got = {r.doc_id: r.n_items for r in ss.mark(documents(rows), benchmark).collect()}
    assert got == {d: brute(t, items) for d, t, _ in rows}
    assert all(got[k] >= 1 for k in range(12)) and (got[20], got[21], got[22], got[23]) == (0, 1, 2, 0)


def test_columns_come_back_as_they_were(spark):
    docs = spark.createDataFrame([(1, "a b c", 7, "x", 5)], "doc_id long, text string, row_id int, item string, n_items int")
    benchmark = spark.createDataFrame([("b c",)], "text string")
    assert ss.mark(docs, benchmark).collect() == [(1, "a b c", 7, "x", 1)]


def test_clean_keeps_callers_columns(spark, documents):
    item = " ".join(f"word{k}" for k in range(25))
    docs = documents([(1, "before " + item + " after", "s"), (2, "nothing of it", "s"), (None, None, None), (2, "nothing of it", "s")])
    mine = docs.selectExpr("*", "7 as n_items", "coalesce(doc_id, 0) + 5 as row_id", "'z' as item")
    found = ss.clean(mine, spark.createDataFrame([(1, item)], "item_id int, text string"))
    assert found.columns == mine.columns
    assert sorted((r.doc_id or 0, r.row_id, r.n_items, r.item) for r in found.collect()) == [(0, 5, 7, "z"), (2, 7, 7, "z"), (2, 7, 7, "z")]
