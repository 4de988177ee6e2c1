import random

import pytest
from pyspark.sql import functions as F

from quarrystone.operators import runs, training
from quarrystone.sources import jsonl
from quarrystone.streaming import stateful


def simulated(calls, period, most):
    """(start, waited) of calls (service, second, id) that are taken in order and recorded when they start."""
    started, out = {}, {}
    for service, second, i in sorted((str(s), t, i) for s, t, i in calls if t is not None):
        held = started.setdefault(service, [])
        now = second
        inside = [t for t in held if t > now - period]
        if len(inside) >= most:
            now = max(now, sorted(held)[-most] + period)
        held.append(now)
        out[i] = (now, now - second)
    return out


@pytest.mark.parametrize(("period", "calls_allowed", "burst", "seed"), [(60, 2, 1, 1), (60, 1, 0, 2), (7, 3, 0, 3), (1, 1, 0, 4), (1000, 30, 10, 5)])
def test_delays_equal_a_sequential_simulation(spark, period, calls_allowed, burst, seed):
    rng = random.Random(seed)
    calls = [(rng.choice(["hot", "hot", "hot", "cold", None]), rng.choice([5, 5, 90, rng.randint(-50, 4000), None if rng.random() < 0.1 else 7]), i) for i in range(600)]
    frame = spark.createDataFrame([(*c, "x") for c in calls], "service string, t long, id long, before string").repartition(5)
    got = runs.delayed_calls(frame, "service", F.col("t"), "id", period, calls_allowed, burst)
    assert got.columns == ["service", "t", "id", "before", "start_second", "waited"] and got.count() == 600
    assert {r.id: (r.start_second, r.waited) for r in got.collect() if r.t is not None} == simulated(calls, period, calls_allowed + burst)
    assert got.filter("t IS NULL AND start_second IS NOT NULL").count() == 0


def test_delays_carry_over_groups_of_blocks(spark):
    """A queue that never empties: its last call starts where thousands of blocks' maxima put it."""
    calls = spark.range(12000).select(F.lit("s").alias("service"), (F.col("id") * 2).alias("t"), "id")
    got = runs.delayed_calls(calls, "service", F.col("t"), "id", 5, 1).agg(F.max("start_second"), F.max("waited")).first()
    assert tuple(got) == (11999 * 5, 11999 * 3)
    assert runs.delayed_calls(calls.limit(0), "service", F.col("t"), "id", 5, 1).count() == 0


def test_carried_sums_and_maxima(spark):
    rows = [(k, i, (i * 37) % 101) for k in "ab" for i in range(0, 60, 1 if k == "a" else 7)]
    frame = spark.createDataFrame(rows, "k string, block long, v long")
    for how, join, plain in ((F.sum, lambda x, y: x + y, sum), (F.max, F.greatest, max)):
        got = {(r.k, r.block): r.before for r in runs.carried(frame, ["k"], "block", "v", how, join, group=8).collect()}
        assert got == {(k, i): plain(v for m, j, v in rows if m == k and j < i) if any(m == k and j < i for m, j, _ in rows) else None for k, i, _ in rows}


def _run(frame, checkpoint):
    got = []
    query = frame.writeStream.foreachBatch(lambda batch, _: got.extend(batch.collect())).option("checkpointLocation", str(checkpoint)).trigger(availableNow=True).start()
    query.awaitTermination()
    return got, query


def test_trailing_calls_equal_the_batch_operator_and_leave_no_state(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, rng.choice("ab"), 1_700_000_000 + rng.choice([rng.randint(0, 400), 77, 78])) for i in range(300)]
    end = [(1000 + k, "z", 1_700_000_000 + 4000 + 4000 * k) for k in range(3)]
    judged = []
    for number, batch in enumerate([rows[:100], rows[100:], end[:1], end[1:2], end[2:]]):
        spark.createDataFrame(batch, "id long, service string, second long").write.mode("append").json(str(tmp_path / "in"))
        events = spark.readStream.schema("id long, service string, second long").json(str(tmp_path / "in")).withColumn("at", F.timestamp_seconds("second"))
        got, _ = _run(stateful.trailing_calls(events, "service", "at", "id", 60, 3, 1, "1 hour"), tmp_path / "checkpoint")
        judged += got
        if number == 1:
            assert judged == []
    batch = runs.rate_limited(spark.createDataFrame(rows, "id long, service string, second long"), "service", F.col("second"), 60, 3, 1)
    want = {r.id: (r.service, r.second, r.earlier, r.can_proceed) for r in batch.collect()}
    assert {int(r.id): (r.service, r.second, r.earlier, r.can_proceed) for r in judged if int(r.id) < 1000} == want
    assert len({r.id for r in judged}) == len(judged)
    state = spark.read.format("statestore").option("path", str(tmp_path / "checkpoint")).option("stateVarName", "calls").load()
    assert state.count() <= 2 and state.filter("key.service <> 'z'").count() == 0


def test_trailing_calls_of_one_service_are_many_groups(spark, tmp_path):
    rng = random.Random(11)
    rows = [(i, "a", 1_700_000_000 + rng.randint(0, 5000)) for i in range(400)]
    judged = []
    for batch in (rows, [(1000, "a", 1_700_000_000 + 5060)], [(1001, "a", 1_700_000_000 + 20_000)]):
        spark.createDataFrame(batch, "id long, service string, second long").write.mode("append").json(str(tmp_path / "in"))
        events = spark.readStream.schema("id long, service string, second long").json(str(tmp_path / "in")).withColumn("at", F.timestamp_seconds("second"))
        judged += _run(stateful.trailing_calls(events, "service", "at", "id", 60, 3, 1, "1 hour"), tmp_path / "checkpoint")[0]
        if len(batch) > 1:
            # Calls up to the watermark, and no others, are judged; the rest wait in more than one group.
            assert {int(r.id) for r in judged} == {i for i, _, second in rows if second + 1 <= max(r[2] for r in rows) - 3600}
            state = spark.read.format("statestore").option("path", str(tmp_path / "checkpoint")).option("stateVarName", "calls").load()
            assert state.select("key").distinct().count() > 1
    want = runs.rate_limited(spark.createDataFrame(rows, "id long, service string, second long"), "service", F.col("second"), 60, 3, 1)
    assert sorted((int(r.id), r.earlier, r.can_proceed) for r in judged if int(r.id) < 1000) == sorted((r.id, r.earlier, r.can_proceed) for r in want.collect())


def _stream(request, n, rng, done=True):
    lines = []
    for i in range(n):
        kind = rng.random()
        text = 'data: {"choices":[{"delta":{"content":"%s"}}]}' % rng.choice(["a", "é ", ""]) if kind < 0.6 else rng.choice([": ping", "", "data: {bad", "data: [1]", 'data: {"usage":{"completion_tokens":%d}}' % i, 'data:{"choices":[]}'])
        lines.append((request, i, rng.randint(0, 50) + 10 * i, text))
    return [*lines, (request, n, 10 * n, "data: [DONE]"), (request, n + 1, 99, 'data: {"choices":[{"delta":{"content":"late"}}]}')] if done else lines


LINES = "request_id string, seq long, ms long, line string"


def _folded(spark, tmp_path, parts):
    """The rows that each part gives, one micro-batch (and one run of the query) a part."""
    for at, part in parts:
        spark.createDataFrame(part, LINES).withColumn("at", F.timestamp_seconds(F.lit(at))).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
        stream = spark.readStream.schema(LINES + ", at timestamp").json(str(tmp_path / "in"))
        yield _run(stateful.token_fold(stream, "at", timeout=30, late="10 seconds"), tmp_path / "checkpoint")[0]


def test_token_fold_of_shuffled_batches_equals_the_batch_fold(spark, tmp_path):
    rng = random.Random(9)
    lines = [x for k in range(6) for x in _stream(f"r{k}", 12, rng)]
    shuffled = lines[:]
    rng.shuffle(shuffled)
    got = [r for rows in _folded(spark, tmp_path, [(1000, shuffled[:30]), (1005, shuffled[30:])]) for r in rows]
    want = jsonl.event_stream_fold(spark.createDataFrame(lines, LINES)).collect()
    key = lambda r: (r.request_id, r.text, r.first_token_ms, r.decode_ms, r.completion_tokens)
    assert sorted(map(key, got), key=str) == sorted(map(key, want), key=str) and all(r.complete for r in got)


def test_token_fold_gives_up_on_a_gap(spark, tmp_path):
    lines = [x for x in _stream("r", 9, random.Random(2), done=False) if x[1] != 4]
    early, late = _folded(spark, tmp_path, [(1000, lines), (2000, [("other", 0, 0, "data: [DONE]")])])
    want = jsonl.event_stream_fold(spark.createDataFrame(lines, LINES)).first()
    assert early == [] and sorted((r.request_id, r.text, r.complete) for r in late) == [("other", "", True), ("r", want.text, False)]


def test_holdout_in_slices(spark, monkeypatch):
    """Many slices, common beginnings, texts beyond the anchor and overlapping ones give what a plain search gives."""
    monkeypatch.setattr(training, "SLICE_BYTES", 300)
    rng = random.Random(6)
    word = lambda: rng.choice(["ab", "b", "é", "c d", "\n", "x" * 70])
    held = ["", None, *{"".join(word() for _ in range(rng.randint(1, 5))) for _ in range(40)}, "y" * 64 + "1", "y" * 64 + "22", "y" * 200]
    held = [h for h in held if not h or len(h) > 3]
    docs = [(i, None if i == 3 else "".join(word() for _ in range(rng.randint(0, 9))) + rng.choice(["", "y" * 64 + "2", "y" * 64 + "22", "y" * 199]), {"clash": 1}) for i in range(200)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, gold map<string,int>").repartition(3)
    kept = training.holdout_exclusion(frame, spark.createDataFrame([(h,) for h in held], "text string"))
    want = [i for i, t, _ in docs if t is None or not any(h and h in t for h in held)]
    assert sorted(r.doc_id for r in kept.collect()) == want and 0 < len(want) < 200 and kept.columns == frame.columns
    plan = kept._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Generate" not in plan


def test_holdout_by_identity(spark):
    docs = spark.createDataFrame([(1, "t1", "x"), (2, "t2", "gold here"), (3, None, "y"), (4, "t4", None)], "doc_id int, task string, text string")
    held = spark.createDataFrame([("t1", "gold"), (None, None), ("t4", "")], "task string, text string")
    assert sorted(r.doc_id for r in training.holdout_exclusion(docs, held, [["task"]]).collect()) == [3]
    assert sorted(r.doc_id for r in training.holdout_exclusion(docs, held).collect()) == [1, 3, 4]
    assert training.holdout_exclusion(docs, held.limit(0), [["task"]]).count() == 4


def test_references_to_json_files(spark):
    files = {
        "a.json": ('[{"text":"a"},"b"]', "a\nb"), "b.json": ('{"z":1,"a":"x"}', '{"a": "x", "z": 1}'), "c.JSON": ('{"messages":[{"role":"user","content":[{"text":"p"},"q"]},{"role":"assistant","content":"no"},{"content":""},{"content":"r"}]}', "user: p\nq\n\nuser: r"),
        "d.json": ("{bad", "{bad"), "e.jsonl": ('{"content":null,"prompt":"p"}', ""), "f.json": ('{"messages":"none","prompt":["a",{"content":"b"},{"é":1}]}', 'a\nb\n{"é": 1}'), "g.json": ('"s"', "s"), "h.md": ('{"content":"c"}', '{"content":"c"}'),
        "i.json": ("null", ""), "j.json": ("", ""), "k.json": ("[1, true, null]", "1\nTrue\nNone"),
    }
    refs = spark.createDataFrame([(n,) for n in files] + [("none.json",)], "ref string")
    texts = spark.createDataFrame([(f"/in/{n}", raw) for n, (raw, _) in files.items()], "path string, content string")
    got = {r.ref: r.value for r in training.dereference(refs, texts, ["/repo", "/in"], strict=False).collect()}
    assert got == {n: text for n, (_, text) in files.items()} | {"none.json": None}
