"""Domains are drawn without repeats inside the window; requests get their instance's history."""

import random

import pytest
from pyspark.sql import functions as F

from duologue.operators import planning, requests

SCHEMA = "corpus_combination_id long, n long, title string, conversation_type string, resumed boolean"


def topics(seed=1):
    rng = random.Random(seed)
    rows = []
    for key in (1, 2, None):
        for n in range(rng.randint(60, 90)):
            rows.append((key, 10 * n + (key or 0), f" title {n} ", rng.choice(["advice", None]), n in (0, 1, 2, 40)))
    rng.shuffle(rows)
    return rows


def test_no_domain_twice_within_the_window(spark):
    rows = topics()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    drawn = {}
    for r in planning.drawn_domains(df, ["n"]).orderBy("pos").collect():
        drawn.setdefault(r.corpus_combination_id, []).append((r.resumed, r.domain))
    orders = set()
    for key, found in drawn.items():
        sessions, now = [], []
        for resumed, domain in found:
            assert resumed == (domain is None)
            if resumed:
                sessions.append(now)
                now = []
            else:
                now.append(domain)
        sessions.append(now)
        for session in sessions:
            for i in range(len(session)):
                assert len(set(session[max(0, i - 23) : i + 1])) == min(i + 1, 24)
        assert sessions[3][:5] == sessions[4][:5]  # begun anew
        orders.add(tuple(sessions[3][:24]))
    assert len(orders) == len(drawn)  # an order of its own for each instance


def test_slots_of_the_next_request(spark):
    rows = topics(2)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    slots = {r.corpus_combination_id: r for r in planning.topic_slots(df, ["n"]).collect()}
    more = spark.createDataFrame([(k, 10**6, "next", None, False) for k in slots], SCHEMA)
    drawn = {r.corpus_combination_id: r.domain for r in planning.drawn_domains(df.unionByName(more), ["n"]).where("title = 'next'").collect()}
    for key, slot in slots.items():
        own = sorted(r for r in rows if r[0] == key)
        assert slot.history.split("\n") == [f"{r[2].strip()} ({r[3] or 'unknown'})" for r in sorted(own, key=lambda r: r[1])]
        assert slot.domain == drawn[key]


def test_both_slots_are_in_the_request(spark):
    df = spark.createDataFrame([(1, 5, "Cats", None, True)], SCHEMA)
    row = planning.topic_slots(df, ["n"]).select("*", *[F.lit(None).cast("string").alias(c) for c in ("language", "agent_emotion", "user_emotion", "agent_accent", "user_accent", "gender_pair")], F.lit(True).alias("include_numbers"))
    (text,) = [r.prompt for r in requests.prompt_table(row, "topic", "corpus_combination_id").collect()]
    assert "area: " in text and "Cats (unknown)" in text


@pytest.mark.parametrize("n", [1, 5])
def test_few_domains(spark, n):
    df = spark.createDataFrame([(1, i, "t", None, False) for i in range(7)], SCHEMA)
    got = [r.domain for r in planning.drawn_domains(df, ["n"], [f"d{i}" for i in range(n)]).orderBy("pos").collect()]
    assert len(set(got)) == n and got[n:] == got[: 7 - n]
