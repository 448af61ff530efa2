"""Quotation linking against a plain implementation on planted conversations."""

import random
import re

import pytest

from strata.llm import quoting as Q

SF_SMALL = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, position string"
A = "The first message says something long enough to quote."
B = "A second opinion comes here.\nIt has two lines of its own."
C = "Third reply, agreeing with parts of it."


def quote(text, level=1):
    return "\n".join("> " * level + line for line in text.split("\n"))


def thread():
    return [
        (1, 0, "user", A),
        (1, 1, "assistant", f"On Monday, Ann wrote:\n{quote(A)}\n\n{B}"),
        (1, 2, "user", f"{quote(A, 2)}\n{quote(B.upper())}\n{C}"),
        (1, 3, "user", "No quote at all here."),
        (1, 4, "assistant", f"before\n> {B.splitlines()[1]}\nafter\n> unknown words that nobody ever said\nend"),
        (1, 5, "user", ">>" + C),
        (2, 0, "user", f"{quote(C)}\nquoting another conversation"),
        (2, 1, "user", quote("Quoting another   conversation!") + "\nok"),
        (None, 0, "user", "A null conversation has words too."),
        (None, 1, "user", "> A null conversation has words too.\nyes"),
        (3, 0, "user", None),
        (3, 1, "user", ""),
        (3, 2, "user", "> "),
        (3, None, "user", "no turn"),
        (4, 0, "user", "say it twice in a row"), (4, 0, "user", "say it twice in a row"), (4, 1, "user", "> say it twice in a row\nagain"),
    ]


def rows_of(spark, rows):
    return Q.link_quotes(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(3))


def test_parents_threads_and_text(spark):
    out = rows_of(spark, thread())
    assert out.columns == ["conv_id", "turn", "role", "text", "n_quotes", "quote_depth", "parent_conv", "parent_turn", "thread_turn", "position"]
    got = {(r.conv_id, r.turn): r for r in out.collect()}
    link = {k: (r.parent_conv, r.parent_turn) for k, r in got.items()}
    assert link[1, 1] == (1, 0) and link[1, 2] == (1, 1) and link[1, 4] == (1, 1)
    assert link[1, 0] == link[1, 3] == (None, None) and link[1, 5] == (1, 2)  # a deeper quote alone links as well
    assert link[2, 0] == (1, 2) and link[2, 1] == (2, 0) and link[None, 1] == (None, 0)
    assert got[1, 1].text == B and got[1, 2].text == C and got[1, 4].text == "before\nafter\nend" and got[1, 5].text == ""
    assert got[3, 0].text is None and got[3, 1].text == "" and got[3, 2].text == "" and got[1, 0].text == A
    assert [got[1, t].n_quotes for t in range(6)] == [0, 1, 2, 0, 2, 1]
    assert [got[1, t].quote_depth for t in range(6)] == [0, 1, 2, 0, 1, 2]
    assert [got[1, t].thread_turn for t in range(6)] == [0, 0, 0, 3, 0, 0]
    assert [got[1, t].position for t in range(6)] == [1, 2, 3, 6, 4, 5]
    assert link[4, 1] == (4, 0) and out.count() == len(thread())


def test_deeper_passages_link(spark):
    rows = [(1, 0, "user", A), (1, 1, "user", B), (1, 2, "user", C), (1, 3, "user", quote(A, 2) + "\nonly a deeper quote"),
            (1, 4, "user", f"> words that nobody ever said\n{quote(C, 3)}\n{quote(B, 2)}\nshallowest that links"),
            (1, 5, "user", f"{quote(A + C, 2)}\n> {B.splitlines()[0]}\nlevel 1 first"), (1, 6, "user", ">>> " + C), (1, 7, "user", "plain")]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(3)
    got = {r.turn: r for r in Q.link_quotes(df, originals_col="originals").collect()}
    assert [got[t].parent_turn for t in range(8)] == [None, None, None, 0, 1, 1, 2, None]
    assert [got[t].thread_turn for t in range(8)] == [0, 1, 2, 0, 1, 1, 2, 7]
    assert [[(p.level, p.text, p.turn, p.found) for p in got[t].originals] for t in (3, 4, 6, 7)] == [
        [(2, A, 0, True)], [(1, "words that nobody ever said", None, False), (3, C, 2, True), (2, B, 1, True)], [(3, C, 2, True)], []]


def test_later_repeats_do_not_hide_another_conversation(spark):
    rows = [(1, 0, "user", "> " + C + "\nfirst"), (1, 1, "user", "between"), (1, 2, "user", C), (5, 3, "user", C), (6, 0, "user", C),
            (None, 0, "user", "> " + A), (None, 1, "user", A), (7, 4, "user", A), (7, 5, "user", "> " + A), (8, 0, "user", "> " + B), (8, 1, "user", B)]
    got = {(r.conv_id, r.turn): (r.parent_conv, r.parent_turn) for r in rows_of(spark, rows).collect()}
    assert got[1, 0] == (5, 3) and got[None, 0] == (7, 4) and got[7, 5] == (7, 4) and got[8, 0] == (None, None)


def test_long_chains_and_shared_lines(spark):
    chain = [(9, i, "user", f"message number {i} of the long chain" + (f"\n> message number {i - 1} of the long chain" if i else "")) for i in range(40)]
    shared = [(100 + i, 0, "user", "the very same opening line") for i in range(200)] + [(100 + i, 1, "user", "> the very same opening line\nmine") for i in range(200)]
    got = {(r.conv_id, r.turn): r for r in rows_of(spark, chain + shared).collect()}
    assert all(got[9, i].thread_turn == 0 and got[9, i].position == i + 1 for i in range(40))
    assert all((got[100 + i, 1].parent_conv, got[100 + i, 1].parent_turn) == (100 + i, 0) for i in range(200))


def plain_parse(text):
    """(own text, passages) of a text line by line."""
    runs = []
    for line in text.replace("\r\n", "\n").split("\n"):
        rest, level = line, 0
        while rest.lstrip(" \t").startswith(">"):
            rest, level = rest.lstrip(" \t")[1:], level + 1
        if level and rest.startswith(" "):
            rest = rest[1:]
        if runs and runs[-1][0] == level:
            runs[-1][1].append(rest)
        else:
            runs.append((level, [rest]))
    own = [("\n".join(t)).strip(" \t\r\n") for lv, t in runs if lv == 0]
    return "\n".join(t for t in own if t), [(lv, "\n".join(t).strip(" \t\r\n")) for lv, t in runs if lv and any(c.isalnum() for x in t for c in x)]


@pytest.mark.parametrize("text", ["a\n> b\n>> c\n> d\ne", "> > x\n>y", "  > z", "a > b", ">>> deep\r\n> up\r\nend", ">", "x\n\n> q\n\n\ny", "> é ü\n> " + "long " * 9000])
def test_parse_matches_plain(spark, text):
    r = Q.parse_quotes(spark.createDataFrame([(text,)], "text string")).first()
    own, passages = plain_parse(text)
    assert (r.own_text or "") .replace("\n", "") == (own if ">" in text and any(x.lstrip(" \t").startswith(">") for x in text.split("\n")) else text).replace("\n", "")
    assert [(p.level, p.text) for p in r.passages] == passages


def plain_keys(text):
    normal = lambda t: re.sub(r"[\W_]+", " ", t.lower()).strip()
    long = [normal(t) for t in re.split(r"\n[ \t]*\n", text) + text.split("\n")]
    return {k for k in [normal(text)] if k} | {k for k in long if len(k) >= Q.MIN_LINE_CHARS}


def plain_link(rows):
    """(parent, thread turn, position, originals) by (conversation, turn), message by message; null conversations are -1."""
    parsed = {(c, t): plain_parse(text) for c, t, text in rows}
    first = {}  # key -> conversation -> first turn that says it
    for (c, t), (own, _) in parsed.items():
        for k in plain_keys(own) if own else ():
            says = first.setdefault(k, {})
            says[c] = min(t, says.get(c, t))
    out = {}
    for (c, t), (_, passages) in parsed.items():
        votes, levels, of = {}, {}, {}
        for level, text in passages:
            for k in plain_keys(text):
                levels[k] = min(level, levels.get(k, level))
        to = {}
        for k in levels:
            says = first.get(k, {})
            others = sorted(x for x in says if x != c)
            if says.get(c, t) < t:
                to[k] = (1, c, says[c])
            elif others:
                to[k] = (0, others[0], says[others[0]])
        best = lambda ks: max(
            ((near, max(map(len, g)), sum(map(len, g)), tt, cc) for (near, cc, tt) in {to[k] for k in ks} for g in [[k for k in ks if to[k] == (near, cc, tt)]]), default=None)
        shallow = min((levels[k] for k in to), default=None)
        b = best([k for k in to if levels[k] == shallow])
        for level, text in passages:
            of[text] = best([k for k in plain_keys(text) if k in to])
        out[c, t] = ((b[4], b[3]) if b else (None, None), [(lv, x, *((of[x][4], of[x][3], True) if of[x] else (None, None, False))) for lv, x in passages])

    def root(c, t):
        (pc, pt), _ = out[c, t]
        return root(c, pt) if pc == c else t

    place = {c: sorted((root(c, t), t) for (x, t) in out if x == c) for c in {c for c, _ in out}}
    return {(c, t): (p, root(c, t), place[c].index((root(c, t), t)) + 1, o) for (c, t), (p, o) in out.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_links_match_plain(spark, seed):
    rng = random.Random(seed)
    pool = ["Yes.", "ok then", "The meeting is on Tuesday.", "Who brings the cake, then?", "Zoë will bring it along.", "nobody told me about this", "It was on the list (twice)!"]
    pool += ["Ein längerer Satz über die Höhe.", "the list is wrong in places", "we should mend it soon"]

    def message():
        lines = []
        for _ in range(rng.randint(1, 4)):
            said = [rng.choice(pool) for _ in range(rng.randint(1, 3))]
            mark = "> " * rng.choice([0, 0, 1, 1, 2, 3])
            lines += [mark + (x.upper() if mark and rng.random() < 0.3 else x) for x in said] + [""] * (rng.random() < 0.3)
        return "\n".join(lines)

    rows = [(c, t, message()) for c in (-1, *range(1, 12)) for t in range(rng.randint(1, 7))]
    df = spark.createDataFrame([(None if c < 0 else c, t, "user", text, "x") for c, t, text in rows], SCHEMA).repartition(5)
    want = plain_link(rows)
    conv = lambda c, found: None if not found else -1 if c is None else c
    for r in Q.link_quotes(df, originals_col="originals").collect():
        parent = (conv(r.parent_conv, r.parent_turn is not None), r.parent_turn)
        originals = [(p.level, p.text, conv(p.conv, p.found), p.turn, p.found) for p in r.originals]
        assert (parent, r.thread_turn, r.position, originals) == want[conv(r.conv_id, True), r.turn]
    assert sum(p[0] != (None, None) for p in want.values()) > 20


def test_query_covers_the_table(spark):
    import __spark_entry__ as E

    out = E.queries()["op6_quote_linking"](spark, SF_SMALL)
    src = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").collect()
    got = sorted((r.conv_id, r.turn, r.text, r.position) for r in out.collect())
    assert [g[:2] for g in got] == sorted((r.conv_id, r.turn) for r in src)
    assert Q.link_quotes(spark.createDataFrame([], SCHEMA)).count() == 0
