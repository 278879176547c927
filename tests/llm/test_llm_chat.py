from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from supplylens.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, quotes string, own string, level int"


def messages(spark, rows):
    return spark.createDataFrame([(*r, "q", "o", 3) for r in rows], SCHEMA)


def order(spark, rows):
    out = chat.reply_order(messages(spark, rows)).collect()
    return [(r.conv_id, r.turn, r.reply_to, r.depth, r.text) for r in out]


def test_quotes_are_linked_and_taken_out(spark):
    rows = [
        (1, 0, "user", "How do I sort a list?\n\nIt is long."),
        (1, 1, "assistant", "Use sorted."),
        (1, 2, "user", "> how do I sort  a list?\nOr in place?"),
        (1, 3, "assistant", "Ann wrote:\n> Use sorted.\nThat copies."),
        (1, 4, "user", ">> Use sorted.\n> That copies.\nI see."),
        (1, 5, "user", "> nobody said this\nHm."),
        (2, 0, "user", "> Use sorted.\nAnother talk."),
    ]
    assert order(spark, rows) == [
        (1, 0, None, 0, "How do I sort a list?\n\nIt is long."),
        (1, 2, 0, 1, "Or in place?"),
        (1, 1, None, 0, "Use sorted."),
        (1, 3, 1, 1, "That copies."),
        (1, 4, 3, 2, "I see."),
        (1, 5, None, 0, "Hm."),
        (2, 0, None, 0, "Another talk."),
    ]


def test_levels_and_passages(spark):
    text = "> a\n> b\n>> c\n> > d\nmine\n>e\n > f\nHe wrote:\nnot \x1ea\x1f quote"
    r = chat.parse_quotes(messages(spark, [(1, 0, "user", text)]).drop("quotes", "own")).first()
    assert [(q.level, q.passage) for q in r.quotes] == [(1, "a\nb"), (2, "c\nd"), (1, "e\nf")]
    assert r.own == "mine\nHe wrote:\nnot \x1ea\x1f quote" and r.runs == ["mine", "He wrote:\nnot \x1ea\x1f quote"]


def test_parts_of_a_message_are_found(spark):
    rows = [
        (1, 0, "user", "a line\nb line\nc line"), (1, 1, "user", "> a line\n> b line\nyes"),
        (2, 0, "user", "one p\n\ntwo\np\n\nthree p"), (2, 1, "user", "three p"), (2, 2, "user", "> two p\n>\n> one p\n> \n> four\nyes"),
        (3, 0, "user", "q"), (3, 1, "user", "> q\nwrapped\nhere\n> q\nmore\n\nlast\npart\n> q\nend"),
        (3, 2, "user", "> wrapped\n> here\nyes"), (3, 3, "user", "> last\n> part\nyes"), (3, 4, "user", "here"),
        (3, 5, "user", "> wrapped here\nyes"),
        (4, 0, "user", "a\nb"), (4, 1, "user", "a"), (4, 2, "user", "> a\n> b\nyes"), (4, 3, "user", "> x\n> a\nyes"),
    ]
    up = {(r[0], r[1]): r[2] for r in order(spark, rows)}
    want = {(1, 1): 0, (2, 2): 0, (3, 1): 0, (3, 2): 1, (3, 3): 1, (3, 5): 1, (4, 2): 0, (4, 3): 1}
    assert {k: v for k, v in up.items() if v is not None} == want
    linked = {(r.conv_id, r.turn): (r.n_quotes, r.n_linked) for r in chat.reply_order(messages(spark, rows)).collect()}
    assert linked[1, 1] == linked[2, 2] == (1, 1) and linked[3, 1] == (3, 1)


def brute(rows):
    said: dict[tuple, list] = {}
    norm = lambda t: " ".join(t.lower().split())
    for conv, turn, _, text in rows:
        own = "\n".join(x for x in text.split("\n") if not x.startswith(">")).strip()
        for unit in {own, *own.split("\n")}:
            if unit.strip():
                said.setdefault((conv, norm(unit)), []).append(turn)
    parents = {}
    for conv, turn, _, text in rows:
        found = [max((t for t in said.get((conv, norm(x[1:])), []) if t < turn), default=None) for x in text.split("\n") if x.startswith(">")]
        found = [t for t in found if t is not None]
        parents[conv, turn] = max(found, default=None)

    def path(conv, turn):
        up = parents[conv, turn]
        return [*(path(conv, up) if up is not None else []), turn]

    keyed = sorted((conv, path(conv, turn)) for conv, turn, _, _ in rows)
    return [(conv, p[-1], parents[conv, p[-1]]) for conv, p in keyed]


def test_random_threads_equal_brute_force(spark):
    rng = random.Random(8)
    rows = []
    for conv in range(12):
        lines: list[str] = []
        for turn in range(rng.randint(1, 25)):
            quote = [f"> {rng.choice(lines).upper()}\nok {conv} {turn}"] if lines and rng.random() < 0.6 else []
            own = f"line {rng.randint(0, 15)} of {conv}"
            rows.append((conv, turn, "user", "\n\n".join([*quote, own]).replace("\n\n", "\nx\n") if quote else own))
            lines.append(own)
    assert [(c, t, up) for c, t, up, _, _ in order(spark, rows)] == brute(rows)


def test_long_threads_take_few_rounds_and_common_lines_no_pairs(spark, monkeypatch):
    held = []
    monkeypatch.setattr(chat, "hold", lambda df, label="table", hold=chat.hold: held.append((label, df)) or hold(df, label))
    rows = [(1, 0, "user", "line 0")] + [(1, k, "user", f"> line {k - 1}\nline {k}") for k in range(1, 41)]
    rows += [(2, 3 * k, "user", "> ok\nok") for k in range(200)]
    out = order(spark, rows)
    assert [(t, up, d) for c, t, up, d, _ in out if c == 1] == [(k, k - 1 if k else None, k) for k in range(41)]
    assert [(t, up, d) for c, t, up, d, _ in out if c == 2] == [(3 * k, 3 * k - 3 if k else None, k) for k in range(200)]
    assert sum(label == "sizes" for label, _ in held) <= 9 and sum(label == "places" for label, _ in held) <= 9
    answers = next(df for label, df in held if label == "answers")
    plan = answers._jdf.queryExecution().optimizedPlan().toString()
    assert "_said" in plan and not re.search(r"_said#\d+L? < _turn", plan)


def test_turns_are_any_longs(spark):
    """Milliseconds, negative turns and the ends of the range, each message answering the one before."""
    turns = [-(2**63), -1000000000002, -1000000000001, -3, 0, 7, 1000000000001, 1000000000002, 2**63 - 1]
    rows = [(1, t, "user", f"> line {k - 1}\nline {k}" if k else "line 0") for k, t in enumerate(turns)]
    rows += [(2, t, "user", f"alone {t}") for t in turns]
    rows += [(3, 1000000000001, "user", "a"), (3, 1000000000002, "user", "b"), (3, 1000000000012, "user", "> b\nyes")]
    out = chat.reply_order(messages(spark, rows).repartition(4)).collect()
    assert [(r.turn, r.reply_to, r.thread, r.place) for r in out if r.conv_id == 1] == [
        (t, turns[k - 1] if k else None, turns[0], k) for k, t in enumerate(turns)
    ]
    assert [(r.turn, r.thread) for r in out if r.conv_id == 2] == [(t, t) for t in turns]
    assert [(r.turn, r.thread, r.place) for r in out if r.conv_id == 3][1:] == [
        (1000000000002, 1000000000002, 0), (1000000000012, 1000000000002, 1)
    ]


def test_a_chain_of_thousands_and_a_message_with_thousands_of_answers(spark):
    """No row grows with its thread; a third of all answers are to one message."""
    n = 20_000
    chain = spark.range(n).selectExpr("1L AS _conv", "id AS _turn", "id - 1 AS _to").where("_turn > 0")
    star = spark.range(n // 2).selectExpr("2L AS _conv", "id + 1 AS _turn", "0L AS _to")
    tree = spark.range(1, n // 2).selectExpr("3L AS _conv", "id AS _turn", "(id - 1) div 2 AS _to")
    found = chat._numbered(chain.union(star).union(tree).repartition(6)).collect()
    by_conv = {c: sorted((r._turn, r._depth, r._thread, r._place) for r in found if r._conv == c) for c in (1, 2, 3)}
    assert by_conv[1] == [(k, k, 0, k) for k in range(n)]
    assert by_conv[2] == [(0, 0, 0, 0)] + [(k, 1, 0, k) for k in range(1, n // 2 + 1)]
    places, stack = {}, [0]
    while stack:  # the binary tree, first answers first
        at = stack.pop()
        places[at] = len(places)
        stack += [k for k in (2 * at + 2, 2 * at + 1) if k < n // 2]
    assert by_conv[3] == [(k, (k + 1).bit_length() - 1, 0, places[k]) for k in range(n // 2)]


def test_awkward_rows(spark):
    rows = [
        (None, 0, "user", "hello"), (1, None, "user", "> hello"), (1, 0, None, None), (1, 0, "user", ""), (1, 0, "user", ""),
        (1, 1, "user", "> " * 400 + "deep"), (1, 2, "user", "x " * 20_000), (1, 3, "user", "> " + "x " * 20_000 + "\nyes"),
    ]
    out = chat.reply_order(messages(spark, rows)).collect()
    assert len(out) == len(rows)
    assert next(r for r in out if r.text == "yes").reply_to == 2
    assert chat.reply_order(messages(spark, []).where(F.lit(False))).count() == 0


def test_sql_says_the_same(spark):
    import duckdb

    from supplylens.llm.queries import ORACLES

    rng = random.Random(3)
    rows = [
        (1, 0, "user", "How do I sort a list?\n\nIt is long."), (1, 1, "assistant", "Use sorted."),
        (1, 2, "user", "> how do I sort  a list?\nOr in place?"), (1, 3, "assistant", "Ann wrote:\n> Use sorted.\nThat copies."),
        (1, 4, "user", ">> Use sorted.\n> That copies.\nI see."), (1, 5, "user", "> a\n> b\n\n> c\n>> d\r\n > e"),
        (2, 0, "user", ""), (2, 1, None, None), (2, 2, "user", " > \n>\n"),
    ]
    for conv in range(3, 16):
        said: list[str] = []
        for turn in range(rng.randint(1, 20)):
            own = [f"line {rng.randint(0, 9)} of {conv}" for _ in range(rng.randint(1, 4))]
            own = "".join(x + rng.choice(["\n", "\n\n", "\n \t\n"]) for x in own) + f"more {turn}"
            quote = ""
            if said and rng.random() < 0.7:  # whole messages, some of their lines, paragraphs of several, what nobody said
                kind, text = rng.random(), rng.choice(said)
                parts = text.split("\n") if kind < 0.4 else re.split(r"\n[ \t]*\n", text)
                lines = text if kind < 0.2 else "\n".join(rng.sample(parts, rng.randint(1, len(parts))) + ["nobody"] * (rng.random() < 0.3))
                marks = rng.choice(["> ", ">", ">> ", " > "])
                quote = rng.choice(["", "Ann wrote:\n"]) + "".join(f"{marks}{x.upper()}\n" for x in lines.split("\n"))
            message = f"{quote}{own}" if rng.random() < 0.6 else f"{own}\n{quote}end {turn}"
            rows.append((conv, turn * rng.choice([1, 10**13]), "user", message))
            said.append(own)
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    want = con.execute(ORACLES["op2_chat_formatting"])
    names = [d[0] for d in want.description]
    got = chat.reply_order(messages(spark, rows)).select(*names).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want.fetchall()))
    assert any(r.depth > 1 for r in got)
