from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import functions as F

from payscope.llm import rule_cascade as R
from tests.conftest import plan_text

_SPACE = r"[\x20\x09-\x0D]+"


def measured(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) by plain loops."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated)
    )


def kept(text):
    text = text or ""
    n, chars, symbols, dup, repeated = measured(text)
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return not (
        n < 50 or 2 * repeated > n or not 2 * n <= chars <= 12 * n or 10 * symbols > n or 10 * dup > 3 * len(lines)
        or 10 * sum(bool(re.search(r"[A-Za-z]|[^\x00-\x7f]", w)) for w in words) < 7 * n
        or 10 * sum(w.endswith("!") for w in words) > 3 * n
        or 2 * len(re.findall("[A-Z]", text)) > len(re.findall("[A-Za-z]", text))
        or 10 * sum(x.endswith(("...", "…")) for x in lines) > 3 * len(lines)
        or 10 * sum(bool(re.match(r"[ \t]*[-*•]", x)) for x in lines) > 9 * len(lines)
    )


ODD = [
    "a b c " * 40, "x\x0by\x0cz\r\n" * 3, "\n\n \n", "one\n one\none\n" + " ".join(f"w{i}" for i in range(60)),
    " ".join(f"wort{i}!" for i in range(60)), " ".join(f"WORT{i}" for i in range(60)), "- point of text\n" * 2 + "\n".join(f"- p{i} q{i} r{i} s{i}" for i in range(30)),
    "\n".join(f"satz {i} bricht ab …" for i in range(30)), " ".join(str(i) for i in range(90)),
    " ".join(f"w{i % 50} v{i % 7}" for i in range(30_000)), "é" * 700 + " " + " ".join(f"é{i}" for i in range(60)),
]


def test_cascade_against_loops(make_docs, rows):
    rows = rows + [(5000 + i, t, "en", "s") for i, t in enumerate(ODD)]
    found = R.cascade(make_docs(rows)).collect()
    assert len(found) == len(rows)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = Counter((r.doc_id, *[r[n] for n in names], r.base_failed, r.kept, r.failed_rule is None) for r in found)
    want = Counter()
    for i, t, _, _ in rows:
        m = measured(t)
        want[(i, *m, m[0] < 50 or 2 * m[4] > m[0], kept(t), kept(t))] += 1
    assert got == want
    reasons = {r.failed_rule for r in found if r.doc_id is not None and r.doc_id >= 5000}
    assert {"base", "at most half of the letters capitals", "at most nine lines in ten behind bullets"} <= reasons


def test_the_verdict_is_the_same_in_every_order(docs):
    rules = R.prose_rules()
    first = {(r.doc_id, r.n_words): r.kept for r in R.cascade(docs, rules).collect()}
    again = {(r.doc_id, r.n_words): r.kept for r in R.cascade(docs, rules[::-1], sample_rows=1).collect()}
    assert first == again


def test_rules_are_ordered_by_rejections_per_cost(spark):
    rules = [R.Rule(n, F.lit(True)) for n in "abc"]
    # c catches what a does and costs a tenth; b catches few others, but they are all that c leaves.
    patterns = [([True, False, True], 50), ([False, True, False], 5), ([False] * 3, 100)]
    assert [r.name for r in R._greedy(rules, [1.0, 1.0, 0.1], patterns)] == ["c", "b", "a"]
    assert [r.name for r in R._greedy(rules, [0.1, 1.0, 1.0], patterns)] == ["a", "b", "c"]


def test_empty_table_own_rules_and_native_plan(no_docs, docs):
    assert R.cascade(no_docs).count() == 0
    short = R.Rule("short", F.size(R.WORDS) < 3)
    found = R.cascade(docs, [short], first=F.lit(False))
    assert {r.kept for r in found.where("n_words < 3").collect()} == {True}
    assert {r.failed_rule for r in found.where("n_words >= 3").collect()} == {"short"}
    plan = plan_text(found)
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
