import re

import pytest
from tests.llm.conftest import make_docs

from atende.llm import quality_rules as q

WS = r"[\x20\x09-\x0D]"


def brute(text):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    seen, hit = {}, set()
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i: i + 8]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            hit |= {i + k for i in at for k in range(8)}
    lines = t.split("\n")
    worded = [x for x in lines if re.search(r"[^\x20\x09-\x0D]", x)]
    figures = (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(worded) - len(set(worded)), len(hit),
    )

    def passes(x):
        if x not in worded:
            return True
        n, s = len(x.split()), len(re.findall(q.SYMBOLS, x))
        menu = sum(x.count(m) for m in q.MENU_MARK) >= 3 or re.search(q.MENU_LINE.replace(r"\z", r"\Z"), x)
        return bool(
            x.rstrip(q.CLOSING)[-1:] in q.SENTENCE_END and x.rstrip(q.CLOSING) and not menu
            and not any(p in x.lower() for p in q.BOILERPLATE) and not (s and 2 * s >= n) and x.count("!!") < 3
        )

    clean = "\n".join(x for x in lines if passes(x))
    failed = figures[0] < 20 or 100 * figures[4] > 30 * figures[0]
    return (*figures, failed, not failed and not 100 * (len(t) - len(clean)) > 50 * len(t)), clean


PROSE = "The quick brown fox of the north jumps over one lazy dog and then runs back home for supper tonight, they say."
CASES = [
    (1, None), (2, ""), (3, PROSE), (4, PROSE), (4, PROSE), (5, f"{PROSE}\n{PROSE}"), (6, "x " * 50), (7, f"{PROSE}\nhome\na | b | c | d.\n\n"),
    (8, "\n".join(["Home", "Menu", "Log in", "item one | item two | item three | four", PROSE])),
    (9, "no end to this line of words " * 6 + "\n" + PROSE), (10, "We use cookies on this site.\n" + PROSE), (None, PROSE + " été 漢字🤦。"),
    (11, "a### b$$$ c&&&. " * 12), (12, "OH!! NO!! NOT!! AGAIN!! " + PROSE + "!!"), (13, "w" * 200_000 + " " + PROSE), (14, "\t\x0b\r\n \n"),
    (15, " ".join(f"w{i % 9}" for i in range(400)) + "."), (16, PROSE + "\r\n" + PROSE.upper() + "\x0b"),
]


def rows_of(df):
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return [(tuple(r[c] for c in cols), r["clean_text"]) for r in df.select("q.*").collect()]


def test_against_brute_force(spark, documents):
    rows = CASES + documents
    got = rows_of(q.quality_rules(make_docs(spark, rows)))
    assert sorted(map(repr, got)) == sorted(repr(brute(t)) for _, t in rows)


def test_empty_table_and_carried_columns(spark):
    docs = make_docs(spark, CASES)
    assert q.quality_rules(docs.where("false")).count() == 0
    assert q.quality_rules(docs).select("row.*").columns == docs.columns


@pytest.mark.parametrize("word", ["Python", "Pandas", "Arrow"])
def test_plan_is_native(spark, documents, word):
    plan = q.quality_rules(make_docs(spark, CASES))._jdf.queryExecution().executedPlan().toString()
    assert word not in plan
