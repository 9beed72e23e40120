"""Packing keeps its promises; apportionment equals the definition; the mix reaches its shares."""

import random
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm.mixing import mix_documents, mix_report, sainte_lague
from millrace.llm.packing import Packer, fill_report, pack, pack_documents
from millrace.llm.tokens import token_counts


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 300), max_size=80), st.integers(1, 100))
def test_no_container_overflows_and_nothing_is_cut_needlessly(sizes, capacity):
    boxes, parts = defaultdict(int), defaultdict(list)
    for item, piece, box, tokens in pack(sizes, capacity):
        boxes[box] += tokens
        parts[item].append(tokens)
    assert all(0 < v <= capacity for v in boxes.values())
    for i, size in enumerate(sizes):
        assert sum(parts[i]) == size and len(parts[i]) == -(-size // capacity)


def test_each_step_is_the_least_sum_of_squares():
    r, packer = random.Random(1), Packer(30)
    for _ in range(300):
        size, before = r.randint(1, 30), packer.count.copy()
        packer.place(size)

        def after(level):
            n = before.copy()
            if level:
                n[level] -= 1
            if level + size < 30:
                n[level + size] += 1
            return int((n**2).sum())

        options = [after(h) for h in range(0, 31 - size) if h == 0 or before[h]]
        assert int((packer.count**2).sum()) == min(options)


def quotients(weights, seats, caps):
    won = dict.fromkeys(weights, 0)
    for _ in range(seats):
        able = [p for p in sorted(weights) if won[p] < caps[p] and weights[p] > 0]
        if not able:
            break
        best = max(able, key=lambda p: (weights[p] / (2 * won[p] + 1)))
        won[best] += 1
    return won


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=5), st.integers(0, 200), st.data())
def test_apportionment_by_highest_quotients(weights, seats, data):
    named = {f"s{i}": float(w) for i, w in enumerate(weights)}
    caps = {p: data.draw(st.integers(0, 120)) for p in named}
    got, want = sainte_lague(named, seats, caps), quotients(named, seats, caps)
    assert sum(got.values()) == sum(want.values())
    assert sorted(named[p] / (2 * got[p] - 1) for p in got if got[p]) == pytest.approx(sorted(named[p] / (2 * want[p] - 1) for p in want if want[p]))


def docs(spark, n=400):
    r = random.Random(7)
    rows = [(i, r.choice(["a", "a", "a", "b", "c"]), " ".join(r.choice(["red", "green", "blue"]) for _ in range(r.randint(1, 60))), "x") for i in range(n)]
    rows += [(n, None, "no source", "x"), (n + 1, "a", None, "x"), (n + 2, "b", "", "x"), (n + 3, "z", "other", "x"), (1, *rows[1][1:])]
    return spark.createDataFrame(rows, "doc_id long, source string, text string, n_tokens string")


def test_packing_table(spark):
    df = docs(spark)
    kinds = spark.createDataFrame([("short", 32), ("long", 128)], "container_kind string, capacity_tokens int")
    packed = pack_documents(df, kinds, shard_items=100)
    want = token_counts(df).agg(F.sum("n_tokens")).first()[0]
    for r in fill_report(packed, kinds).collect():
        assert r.n_tokens == want and r.fullest <= r.capacity_tokens and r.fill_share > 0.7
    assert pack_documents(df.limit(0), kinds).count() == 0


def test_mix(spark):
    df = docs(spark)
    goals = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.2, 3), ("none", 0.1, 2)], "source string, target_share double, max_repeats int")
    mixed = mix_documents(df, goals, block_tokens=40, shard_tokens=2000)
    assert mixed.count() == df.count()
    report = {r.source: r for r in mix_report(mixed, goals).collect()}
    assert report["none"].actual_share == 0 and all(r.most_times <= r.max_repeats for r in report.values())
    for s, share in (("a", 0.5), ("b", 0.3), ("c", 0.2)):
        assert abs(report[s].actual_share - share) < 0.03, report
    assert sorted(mixed.collect()) == sorted(mix_documents(df, goals, block_tokens=40, shard_tokens=2000).collect())
    capped = {r.source: r for r in mix_report(mix_documents(df, goals, total_tokens=10**7, block_tokens=40), goals).collect()}
    assert capped["a"].most_times == 1 and capped["c"].most_times == 3
    assert mix_documents(df.limit(0), goals).count() == 0
