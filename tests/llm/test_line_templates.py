import re
from collections import defaultdict

from tests.llm.frames import TEXTS, documents, ids, prose
from tidemark.llm.line_templates import without_recurring_lines


def masked(line):
    line = re.sub(r"[ \t\r]+", " ", line).strip(" ")
    return re.sub(r"[^ ]*[0-9][^ ]*", "<*>", line)


def brute(texts, min_docs=3, share=0.6, long_docs=2):
    lines = []
    for key in dict.fromkeys(texts):
        lines += [(key, n, m) for n, raw in enumerate((key[1] or "").split("\n")) if (m := masked(raw))]
    needed = lambda m: min(min_docs, long_docs) if m.count(" ") >= 49 else min_docs
    leaf = lambda m: (m.count(" ") + 1, *m.split(" ")[:3])
    holders, tokens = defaultdict(set), defaultdict(int)
    for key, _, m in lines:
        holders[m].add(key[1])
    for m, docs in holders.items():
        own = leaf(m)
        for at, t in enumerate(m.split(" ")):
            tokens[own, at, t] += len(docs)
    template = {}
    for m in holders:
        own, least = leaf(m), needed(m)
        often = [(t, tokens[own, at, t] >= least) for at, t in enumerate(m.split(" "))]
        kept = sum(o and t != "<*>" for t, o in often) / len(often)
        template[m] = (leaf(m), " ".join(t if o else "<*>" for t, o in often) if kept >= share else m)
    spread = defaultdict(set)
    for key, _, m in lines:
        spread[template[m]].add(key[1])
    gone = {(key, n) for key, n, m in lines if len(spread[template[m]]) >= needed(m)}
    out = []
    for key in texts:
        own = [] if key[1] is None else key[1].split("\n")
        kept = [x for n, x in enumerate(own) if (key, n) not in gone]
        out.append((key[0], len(own), len(own) - len(kept), None if key[1] is None else "\n".join(kept)))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "n_lines", "n_dropped", "text")


def test_templates_with_variable_fields_are_dropped(spark):
    people = ["ann", "bob", "cleo", "dan", "eve", "fay"]
    texts = [(i, f"{prose(700 + i, 12)}\nPosted on 2024-01-{i + 10} by {people[i]} in the news section\n\nshort line\n{prose(800 + i, 9)}") for i in range(6)]
    found = {r["doc_id"]: r for r in without_recurring_lines(documents(spark, texts), min_docs=3).collect()}
    for i, text in texts:
        lines = text.split("\n")
        assert found[i]["text"] == "\n".join([lines[0], "", lines[4]]) and found[i]["n_dropped"] == 2 and found[i]["n_lines"] == 5
    assert ids(without_recurring_lines(documents(spark, texts), min_docs=3), *COLUMNS) == brute(texts)


def test_brute_force(spark):
    texts = TEXTS + [(300 + i, "\n".join([f"seen {i % 4} times here", prose(i % 11, 8), "", "Share this\tpage", "a 1 b 2 c"])) for i in range(30)]
    assert ids(without_recurring_lines(documents(spark, texts), min_docs=3), *COLUMNS) == brute(texts)


def test_all_lines_dropped_and_empty_table(spark):
    texts = [(i, "one and the same line" + " " * i) for i in range(4)]
    assert [(r["n_dropped"], r["text"]) for r in without_recurring_lines(documents(spark, texts), min_docs=3).collect()] == [(1, "")] * 4
    assert without_recurring_lines(documents(spark, [])).count() == 0


def test_production_bounds(spark):
    """Passages of over 50 words in two documents go, short lines in two stay, exact copies are no recurrence."""
    passage = prose(31, 60).replace("\n", " ")
    assert passage.count(" ") >= 50
    copy = "\n".join(prose(40 + k, 9).replace("\n", " ") for k in range(3))
    texts = [(i, f"{prose(900 + i, 12)}\n{passage}\n{prose(950 + i, 9)}") for i in range(2)]
    texts += [(10 + i, f"{prose(970 + i, 11)}\nseen in two places only") for i in range(2)]
    texts += [(20 + i, copy) for i in range(5)]
    texts += [(30 + i, f"{prose(990 + i, 7)}\nseen in three places here") for i in range(3)]
    found = {r["doc_id"]: r for r in without_recurring_lines(documents(spark, texts)).collect()}
    assert all(found[i]["n_dropped"] == 1 and passage not in found[i]["text"] for i in range(2))
    assert all(found[i]["n_dropped"] == 0 for i in (10, 11, 20, 21, 22, 23, 24))
    assert all(found[i]["n_dropped"] == 1 for i in (30, 31, 32))
    assert ids(without_recurring_lines(documents(spark, texts)), *COLUMNS) == brute(texts)
