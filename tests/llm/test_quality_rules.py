"""The quality cascade against plain Python, and its order of rules."""

from __future__ import annotations

import re
from collections import Counter

from alertscope.llm import quality_rules as Q


def measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


TEXTS = [
    None, "", " \n\t\x0b ", "a", "a b c a b c", "a b c d a b c", "x x x x x", "one\none\n\n \n \none \ntwo",
    "a # $$ | <b>", "é 😀 ñ\x1cz", "a\xa0b c", "\x00 a", "l1\r\nl1\r\nl1", "word " * 60, " ".join("abcdefgh"[i % 8 :] + "klmnop"[i // 8 % 6 :] + "xyz" for i in range(60)),
    " ".join(f"w{i}" for i in range(60)) + "\n" + " ".join(f"w{i}" for i in range(60)), "LOUD!! " * 5 + " ".join(f"SH{i}!!" for i in range(80)),
    "…\n" * 10, " ".join("ab" * (i % 9 + 1) + str(i * i % 7) for i in range(20000)),
]


def test_measures(spark):
    rows = [(i, t, "x", 5) for i, t in enumerate(TEXTS)] + [(4, TEXTS[4], "x", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string, n_words int")
    got = Q.quality_cascade(df, order=list(range(len(Q.DEFAULT_RULES)))).collect()
    assert len(got) == len(rows)
    for r in got:
        want = measures(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, repr(r.text)[:60]
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert r.kept == (r.rejected_by is None) and (r.rejected_by == "base") == r.base_failed
    assert Q.quality_cascade(df.limit(0)).count() == 0


def test_order_changes_no_verdict(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    n = len(Q.DEFAULT_RULES)
    one = {r.doc_id: r.kept for r in Q.quality_cascade(df, order=list(range(n))).collect()}
    two = {r.doc_id: r.kept for r in Q.quality_cascade(df, order=list(range(n))[::-1]).collect()}
    three = {r.doc_id: r.kept for r in Q.quality_cascade(df).collect()}
    assert one == two == three and not one[16] and one[14]


def test_order_by_rejection_per_cost():
    # rule 0 rejects most but is dear, rule 2 repeats what rule 1 rejects
    patterns = {0b000: 50, 0b001: 30, 0b110: 20, 0b111: 10}
    assert Q.order_by_rejection_per_cost([10.0, 1.0, 2.0], patterns) == [1, 0, 2]
    assert Q.order_by_rejection_per_cost([1.0, 1.0, 2.0], patterns) == [0, 1, 2]
    assert sorted(Q.order_by_rejection_per_cost([3.0, 1.0, 2.0], {})) == [0, 1, 2]
    assert Q.order_by_rejection_per_cost([3.0, 1.0, 2.0], {0: 5})[0] == 1


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    plan = Q.quality_cascade(df, order=[0, 1])._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
