"""Mixing against a step-by-step version; packing against its promises."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from texts import documents, words  # noqa: F401

from tallyhouse.llm import mixing, packing


def given(n=150):
    draw = random.Random(2)
    rows = [(i, " ".join(words(i, draw.randrange(0, 40))), draw.choice(["a", "a", "a", "b", "c", "d", None])) for i in range(n)]
    return rows + [(n, None, "a"), (n + 1, "", "empty"), (n + 2, " ".join(words(9, 3000)), "b"), (n + 3, "one", "é")]


def expected_targets(sizes, weights, percent=150, cap=2):
    """Share, cut what is above the cap, share the rest again by weight, until none is above."""
    total = sum(sizes.values()) * percent / 100
    target, free = {}, set(sizes)
    while free:
        rest = total - sum(target.values())
        weight = sum(weights[s] for s in free)
        over = {s for s in free if rest * weights[s] / weight >= cap * sizes[s]}
        if not over:
            target |= {s: rest * weights[s] / weight for s in free}
            break
        target |= {s: float(cap * sizes[s]) for s in over}
        free -= over
    return target


def test_mix(documents):
    rows = given()
    got = mixing.mix(documents(*rows)).collect()
    size = {i: len((t or "").split()) for i, t, _ in rows}
    source = {i: s for i, _, s in rows}
    sizes = defaultdict(int)
    for i in size:
        sizes[source[i]] += size[i]
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target = expected_targets(sizes, weights)
    assert sorted(r["doc_id"] for r in got) == sorted(size)
    taken = defaultdict(int)
    for r in got:
        s = source[r["doc_id"]]
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == sizes[s]
        assert r["target"] == pytest.approx(target[s])
        assert r["taken"] == r["passes"] * r["size"] and 0 <= r["passes"] <= 2
        assert len(r["positions"]) == r["passes"] and all(0 <= p <= 1 for p in r["positions"])
        assert r["positions"] == sorted(r["positions"])
        taken[s] += r["taken"]
    for s in sizes:
        longest = max((size[i] for i in size if source[i] == s), default=0)
        assert abs(taken[s] - target[s]) <= longest / 2 + 1e-6
    assert sum(target.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_reruns_and_other_partitions_agree(documents):
    rows = given(60)
    first = sorted(mixing.mix(documents(*rows)).collect())
    assert first == sorted(mixing.mix(documents(*rows[::-1]).repartition(7)).collect())


def test_positions_follow_the_schedule(spark):
    shares = spark.range(0, 1001).select((F.col("id") / 1000).alias("u"))
    for schedule in (*mixing.CURRICULUM, mixing.Schedule(0, 1, 0), mixing.Schedule(1, 0, 0), mixing.Schedule(0, 0, 3)):
        times = [r[0] for r in shares.orderBy("u").select(mixing.due_at(schedule, F.col("u"))).collect()]
        assert times == sorted(times) and 0 <= times[0] and times[-1] <= 1

        def area(t, s=schedule):
            first = min(t, 0.5)
            value = s.start * first + (s.middle - s.start) * first * first
            if t > 0.5:
                x = t - 0.5
                value += s.middle * x + (s.end - s.middle) * x * x
            return value

        whole = sum(schedule.halves)
        for i in range(1, 1000, 37):
            assert area(times[i]) / whole == pytest.approx(i / 1000, abs=1e-9)


def test_training_order_and_empty_table(documents):
    mixed = mixing.mix(documents(*given(40)))
    ordered = [r["position"] for r in mixing.training_order(mixed, "doc_id").collect()]
    assert ordered == sorted(ordered) and len(ordered) == sum(r["passes"] for r in mixed.collect())
    none = documents((1, "a")).filter("doc_id > 5")
    assert mixing.mix(none).collect() == []
    blank = mixing.mix(documents((1, None), (2, ""))).collect()
    assert [r["taken"] for r in blank] == [0, 0]
    assert hashlib.md5(b"1").hexdigest()  # the order within a source is that of these digests


def check_packing(rows, got, lengths):
    size = {i: len((t or "").split()) for i, t in rows}
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append((r["start"], r["size"], r["piece"]))
        bins[r["bin_id"]].append((r["place"], r["size"], r["bin_length"]))
    assert set(pieces) == {i for i in size if size[i]}
    for i, found in pieces.items():
        at = 0
        for n, (start, length, piece) in enumerate(sorted(found)):
            assert start == at and piece == n and 0 < length <= max(lengths)
            at += length
        assert at == size[i]
    for found in bins.values():
        at = 0
        for place, length, _ in sorted(found):
            assert place == at
            at += length
        assert {b for _, _, b in found} == {min(x for x in lengths if x >= at)}
    return bins


def test_pack(documents):
    draw = random.Random(8)
    rows = [(i, " ".join(words(i, draw.choice([0, 1, 5, 9, 17, 33, 70])))) for i in range(120)] + [(200, None), (201, " \n"), (202, "x " * 1000)]
    for shard in (1000, 25):
        got = packing.pack(documents(*rows), lengths=(16, 32, 64), overhead=2, shard_pieces=shard).collect()
        check_packing(rows, got, (16, 32, 64))
    assert packing.pack(documents((1, "a")).filter("doc_id > 5")).collect() == []


def test_best_fit_is_the_fullest_bin_with_room():
    draw = random.Random(1)
    for _ in range(50):
        sizes = sorted((draw.randrange(1, 33) for _ in range(60)), reverse=True)
        chosen, content = packing.best_fit(sizes, (16, 32), 32, 1)
        free, expected = [], []
        for size in sizes:  # the plain search over all bins
            fits = [f for f in free if f >= size]
            if fits:
                best = min(fits)
                free.remove(best)
                expected.append(best - size)
                free.append(best - size)
            else:
                free.append(32 - size)
        assert sorted(32 - c for c in content) == sorted(free)
        assert len(chosen) == len(sizes) and sum(content) == sum(sizes)


def test_joint_lengths_cost_no_more_than_one_length():
    draw = random.Random(4)
    for _ in range(30):
        sizes = sorted((draw.randrange(1, 65) for _ in range(80)), reverse=True)
        _, several = packing.pack_shard(sizes, (16, 32, 64), 3)
        _, one = packing.pack_shard(sizes, (64,), 3)
        assert sum(several) + 3 * len(several) <= sum(one) + 3 * len(one)


def test_rows_without_an_id_spread(documents, monkeypatch):
    rows = [(None, " ".join(words(i, 5)), "a") for i in range(200)]
    got = packing.pack(documents(*[r[:2] for r in rows]), lengths=(16,), shard_pieces=20).collect()
    assert len(got) == 200 and len({r["bin_id"] >> 32 for r in got}) == 10
    written = {}

    class Recording(mixing.Scratch):
        def write(self, df, name):
            written[name] = super().write(df, name)
            return written[name]

    monkeypatch.setattr(mixing, "Scratch", Recording)
    assert mixing.mix(documents(*rows)).count() == 200
    assert written["sizes"].select("bucket").distinct().count() > 150
