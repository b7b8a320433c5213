"""Operators with an exact answer against plain Python, on whole tables and on edge cases."""

import brute
import pytest
from pyspark.sql import functions as F

from siltstone.llm import chat, decontaminate, quality, suffixes
from siltstone.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def decontaminated(docs, items):
    told = decontaminate.contaminated(docs, items)
    return told.select(
        "doc_id", "n_words", "n_hit", F.size("items").alias("k"), F.sha2(F.array_join("items", ","), 256).alias("d"), "contaminated")


def test_repeats(documents, edges, empty, pairs, tuples):
    for docs in (documents, edges):
        assert tuples(suffixes.remove_repeats(docs), "*") == brute.repeats(pairs(docs))
    assert suffixes.remove_repeats(empty).count() == 0


def test_many_repeated_rows_take_linear_work(spark, tuples):
    import time

    base = "".join(chr(97 + (k * k * 7 + k * 3) % 26) for k in range(3000))
    rows = [(7, base)] * 800 + [(8, base[500:1500] + "unlike")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    begun = time.time()
    got = tuples(suffixes.remove_repeats(df), "*")
    assert time.time() - begun < 60
    one = brute.repeats([(7, base), (7, base), (8, base[500:1500] + "unlike")])
    assert got == sorted([next(r for r in one if r[0] == 7)] * 800 + [r for r in one if r[0] == 8], key=str)


def test_portions_change_nothing(documents, tuples, monkeypatch):
    want = tuples(suffixes.remove_repeats(documents), "*")
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"text": ["ab", None, "c" * 50, "", "d"], "runs": [None, [1, 2], [], [3], None]})
    monkeypatch.setattr(suffixes, "PORTION", 40)
    assert [len(p) for p in suffixes._portions(iter([batch]), "runs")] == [2, 1, 1, 1]
    assert tuples(suffixes.remove_repeats(documents), "*") == want


@pytest.mark.parametrize("length,gram", [(20, 6), (16, 8)])
def test_repeats_in_periodic_text(spark, tuples, length, gram):
    rows = [(1, "ab" * 100), (2, "ab" * 57 + "c"), (3, "a" * 300), (3, "a" * 300), (4, "abc" * 20 + "abd" * 20), (5, "b" + "ab" * 9 + "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert tuples(suffixes.remove_repeats(df, length=length, gram=gram), "*") == brute.repeats(rows, length)


def test_pieces_are_stitched(spark, tuples, monkeypatch):
    rows = [(i, "".join(chr(97 + (i * k * k + k) % 7) for k in range(900))) for i in (1, 2, 8, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute.repeats(rows, 20)
    monkeypatch.setattr(suffixes, "PIECE", 64)
    got = []
    import numpy as np

    for _, text in rows:
        raw = np.frombuffer(text.encode(), np.uint8)
        got.append(sum(int(n.sum()) for n in suffixes._runs(raw, np.array([0, len(raw)]), 20, 6)[2:3]))
    assert got == [881] * 4  # every window is in one run
    assert tuples(suffixes.remove_repeats(df, length=20, gram=6), "*") == want


def test_contamination(spark, documents, edges, empty, pairs, tuples):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    known = [(r.item_id, r.text) for r in items.collect()]
    assert tuples(decontaminated(documents, items), "*") == brute.contamination(pairs(documents), known)
    odd = [(1, "the cat SAT on"), (2, None), (3, ""), (None, "w1 w2 w3"), (4, "привет мир"), (5, "one"), (5, "two"), (6, "one"),
           (7, " ".join(f"w{i}" for i in range(20)))]
    few = spark.createDataFrame(odd, "item_id long, text string")
    assert tuples(decontaminated(edges, few), "*") == brute.contamination(pairs(edges), odd)
    assert decontaminated(empty, few).count() == 0
    assert all(r.n_hit == 0 for r in decontaminated(edges, few.limit(0)).collect())


def test_contamination_by_large_item_tables(spark, edges, pairs, tuples, monkeypatch):
    items = [(7, " ".join(f"w{i}" for i in range(20))), (1, "the cat SAT on"), (2, "the cat sat on the mat")]
    monkeypatch.setattr(decontaminate, "SENT", 0)
    few = spark.createDataFrame(items, "item_id long, text string")
    assert tuples(decontaminated(edges, few), "*") == brute.contamination(pairs(edges), items)


def test_base_counts(documents, edges, empty, pairs, tuples):
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    for docs in (documents, edges):
        assert tuples(quality.quality(docs), *names) == brute.base_counts(pairs(docs))
    assert quality.quality(empty).count() == 0


def test_bad_lines_go_and_then_the_text(spark):
    good = " ".join(f"word{i}" for i in range(30)) + "."
    more = " ".join(f"other{i}" for i in range(30)) + "."
    rows = [
        (1, "\n".join([good, "Home | News | Contact | Login", "Licensed under X.", more])),
        (2, "\n".join([good, more[:-1], good.upper()[:-1]])),
        (3, "too short."),
    ]
    got = {r.doc_id: r for r in quality.quality(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].kept and got[1].n_lines_kept == 2 and "Home" not in got[1].clean_text
    assert not got[2].kept and not got[2].base_failed
    assert got[3].base_failed and not got[3].kept


def test_chats(spark, tuples):
    got = tuples(QUERIES["op9_chats"](spark, SF), "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    say = "\\### Assistant: </turn> ok"
    assert got == brute.chats(rows + [(-7, 0, "user", say), (-7, 1, "assistant", say)])


def test_chats_read_back_and_validate(spark):
    nasty = ["</turn>\n", "\\l", "\\b<turn>", "<says>", "", None, "\\", "a\nb", "é</tu"]
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(nasty + ["x"])]
    rows += [(2, 0, "assistant", "hi"), (3, 0, "user", "u"), (None, 0, None, "?"), (4, 0, "u<s>\\", "t"), (5, 1, "user", "same"), (5, 1, "user", "same")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    told = chat.format_chats(df).select(
        "conv_id", "valid", chat.parse_chat(chat.formatted()).alias("back"), chat.learned_text().alias("learned"))
    got = {r.conv_id: r for r in told.collect()}
    assert [(t.role, t.text) for t in got[1].back] == [(r, t or "") for _, _, r, t in rows[:10]]
    assert got[1].learned == "".join(t or "" for _, _, r, t in rows[:10] if r == "assistant")
    assert {k: r.valid for k, r in got.items()} == {1: True, 2: False, 3: False, None: False, 4: False, 5: False}
    assert [(t.role, t.text) for t in got[4].back] == [("u<s>\\", "t")] and len(got[5].back) == 2
    assert chat.format_chats(df.limit(0)).count() == 0


def test_many_separators_in_a_fresh_session():
    # Patterns that recurse end a session whose code is not compiled yet, so it takes a process of its own.
    code = """
from siltstone.session import build_session
from siltstone.llm import quality
spark = build_session("marks", "local[1]", spark__ui__enabled="false", spark__sql__shuffle__partitions="1")
rows = [(1, "a/" * 200_000 + "end."), (2, "a / b / c."), (3, "a / b / c / d."), (4, ("x. " * 30_000)), (5, " " * 200_000 + "."), (6, ".\\"" * 100_000 + "x")]
told = quality.quality(spark.createDataFrame(rows, "doc_id long, text string")).collect()
print("LINES", sorted((r.doc_id, r.n_lines_kept) for r in told))
"""
    import os
    import subprocess
    import sys

    import siltstone

    root = os.path.dirname(os.path.dirname(siltstone.__file__))
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=300)
    assert "LINES [(1, 0), (2, 1), (3, 0), (4, 1), (5, 1), (6, 0)]" in done.stdout, done.stderr[-2000:]


def plain_verdict(text):
    """n_lines, n_lines_kept, kept: the rules of the operator, line by line."""
    import re

    spaces = " \t\n\v\f\r"
    strip = lambda x: "".join(c for c in x if c not in spaces)
    split = lambda x: re.findall(r"[^\x20\x09-\x0D]+", x)
    text = text or ""
    lines = [x for x in text.split("\n") if split(x)]

    def good(line):
        n, solid = len(split(line)), strip(line)
        end = line.rstrip(spaces).rstrip("\"')]”’»")
        return (
            bool(end) and end[-1] in ".!?:;…。"
            and 100 * sum(c in "#*$%&|<>" for c in solid) <= 10 * len(solid)
            and not (n <= 12 and sum(c in "|>»·•/" for c in line) >= 3)
            and not re.search(quality.BOILERPLATE, line))

    kept = [x for x in lines if good(x)]
    w = split(text)
    from collections import Counter

    seen = Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
    covered = {p for k in range(len(w) - 2) if seen[tuple(w[k:k + 3])] > 1 for p in (k, k + 1, k + 2)}
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(lines), len(kept), not failed and 100 * len(strip("\n".join(kept))) >= 50 * len(strip(text))


def test_verdict_against_python(documents, edges, spark, pairs):
    odd = [(i, x) for i, x in enumerate([
        "Home | News | About | Login", "a/b/c/d.", "He said \"so.\"  ", "x" * 30 + ".", "## ** $$ fine.", "Click HERE now.",
        "one two three.\n" * 40, "\n".join(f"line {i} ends here." if i % 2 else f"line {i} does not" for i in range(40))])]
    for docs in (documents, edges, spark.createDataFrame(odd, "doc_id long, text string")):
        got = sorted(((r.doc_id, r.n_lines, r.n_lines_kept, r.kept) for r in quality.quality(docs).collect()), key=str)
        assert got == sorted(((i, *plain_verdict(t)) for i, t in pairs(docs)), key=str)
