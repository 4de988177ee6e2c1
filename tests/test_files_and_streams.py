import fnmatch
import hashlib
import json
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from quarrystone.sources import files, jsonl, scrapers, storage, tail
from quarrystone.streaming import progress


def _event(i, **more):
    return json.dumps({"status": "ok", "rel_path": f"r{i}"} | more) + "\n"


def _until(done, seconds=40):
    end = time.monotonic() + seconds
    while not done() and time.monotonic() < end:
        time.sleep(0.2)
    assert done()


def _drain(spark, frame, out, checkpoint):
    query = frame.writeStream.format("parquet").option("path", str(out)).option("checkpointLocation", str(checkpoint)).trigger(availableNow=True).start()
    query.awaitTermination()
    return sorted(r.rel_path for r in spark.read.schema("rel_path string").parquet(str(out)).collect())


def test_tail_of_a_growing_log_over_restarts(spark, tmp_path):
    """Appended lines arrive once, a line that is still being written waits, a restart goes on at the byte where it stopped."""
    log, out, checkpoint = tmp_path / "logs" / "a" / "p.jsonl", tmp_path / "out", tmp_path / "checkpoint"
    log.parent.mkdir(parents=True)
    log.write_text(_event(1) + "\n[1]\n{bad\n" + _event(2) + '{"status": "ok", "rel')
    tailed = lambda **o: progress.tail_events(spark, str(tmp_path / "logs"), suffix=".jsonl", **o).select("rel_path")
    assert _drain(spark, tailed(), out, checkpoint) == ["r1", "r2"]
    with log.open("a") as f:
        f.write('_path": "r3"}\n' + _event(4))
    (tmp_path / "logs" / "late.jsonl").write_text(_event(5))
    (tmp_path / "logs" / "other.txt").write_text(_event(6))
    assert _drain(spark, tailed(), out, checkpoint) == ["r1", "r2", "r3", "r4", "r5"]
    assert _drain(spark, tailed(), out, checkpoint) == ["r1", "r2", "r3", "r4", "r5"]
    with log.open("a") as f:
        f.write(_event(7).rstrip("\n"))
    assert len(_drain(spark, tailed(), out, checkpoint)) == 5
    assert _drain(spark, tailed(drain="true"), out, checkpoint) == ["r1", "r2", "r3", "r4", "r5", "r7"]
    log.write_text(_event(8))  # a new, shorter file of that name
    assert _drain(spark, tailed(), out, checkpoint)[-1] == "r8"


def test_tail_while_a_query_runs(spark, tmp_path):
    (tmp_path / "logs").mkdir()
    log = tmp_path / "logs" / "p.jsonl"
    log.write_text(_event(0))
    got = []
    stream = progress.tail_events(spark, str(tmp_path / "logs"), **{"from": "end"}).select("rel_path")
    query = stream.writeStream.foreachBatch(lambda batch, _: got.extend(r.rel_path for r in batch.collect())).option("checkpointLocation", str(tmp_path / "c")).start()
    try:
        _until(lambda: query.status["message"].startswith("Waiting"))
        for i in (1, 2, 3):
            with log.open("a") as f:
                f.write(_event(i))
            _until(lambda: len(got) == i)  # noqa: B023
    finally:
        query.stop()
    assert got == ["r1", "r2", "r3"]


@pytest.mark.parametrize("block", [5, 64, 1 << 16])
def test_ranges_of_lines_are_exact_wherever_they_are_cut(tmp_path, monkeypatch, block):
    monkeypatch.setattr(storage, "BLOCK", block)
    rng = random.Random(3)
    path = tmp_path / "x"
    for _ in range(12):
        raw = b"\n".join(bytes(rng.choice(b"ab\r") for _ in range(rng.choice([0, 0, 1, 3, 30]))) for _ in range(rng.randint(1, 12)))
        path.write_bytes(raw)
        begin = rng.choice([0, raw.find(b"\n") + 1])
        stop = storage.last_line_end(str(path), begin, len(raw))
        assert stop == max(begin, raw.rfind(b"\n") + 1)
        for stop in {stop, len(raw)}:
            want, at = [], begin
            for line in raw[begin:stop].split(b"\n")[: -1 if raw[begin:stop].endswith(b"\n") else None] if stop > begin else []:
                want.append((at, line.removesuffix(b"\r")))
                at += len(line) + 1
            reader = tail._Reader({"path": "p", "split_bytes": str(rng.choice([1, 2, 7, 1000]))})
            parts = reader.partitions({"files": {"p": begin}}, {"files": {"p": stop}})
            assert [x for p in parts for x in storage.lines(str(path), p.start, p.end, p.stop, p.first)] == want


def test_running_aggregates_land_in_shared_storage(spark, tmp_path):
    folder = tmp_path / "events"
    folder.mkdir()
    for i in range(3):
        (folder / f"{i}.json").write_text("".join(json.dumps({"at": f"2024-01-01T0{i}:{m:02d}:00Z", "service": "s"}) + "\n" for m in range(0, 60, 20)))
    events = spark.readStream.schema("at timestamp, service string").option("maxFilesPerTrigger", 1).json(str(folder))
    calls = progress.sliding_calls(events, "at", "service", "1 hour", "30 minutes", "1 day").select("service", F.col("window.start").cast("string").alias("start"), "calls")
    got = {r.start: r.calls for r in progress.run_to_table(calls, ["service", "start"]).collect()}
    assert got == {"2023-12-31 23:30:00": 2, "2024-01-01 00:00:00": 3, "2024-01-01 00:30:00": 3, "2024-01-01 01:00:00": 3, "2024-01-01 01:30:00": 3, "2024-01-01 02:00:00": 3, "2024-01-01 02:30:00": 1}


def test_walk_equals_a_plain_one(spark, tmp_path):
    root = tmp_path / "r+x (1) [a]*é"
    names = ["a/b/c/d/e.pdf", "a/b/c/d/f.PDF", "a/empty.pdf", ".hidden/x.pdf", "_under/y.pdf", "z.txt", "a b/ä+%20.pdf", "pdf", "a/.pdf"]
    for name in names:
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(b"x" * (0 if "empty" in name else len(name)))
    (root / "nothing" / "here").mkdir(parents=True)
    os.symlink(root, root / "a" / "loop")
    for given in (str(root), f"{root}/", f"file://{root}"):
        got = {r.rel_path: (r.path, r.filename, r.size_bytes, r.mtime_ns, round(r.modified.timestamp(), 3)) for r in files.list_files(spark, given, "").collect()}
        want = {}
        for p in root.rglob("*"):
            if p.is_file() and "loop" not in p.parts:
                s = p.stat()
                want[str(p.relative_to(root))] = (f"file:{p}", p.name, s.st_size, s.st_mtime_ns, round(s.st_mtime, 3))
        assert got.keys() == want.keys() and {k: v[:4] for k, v in got.items()} == {k: v[:4] for k, v in want.items()}
    assert sorted(r.rel_path for r in files.list_files(spark, str(root)).collect()) == sorted(n for n in names if n.lower().endswith(".pdf"))
    assert files.list_files(spark, str(root), any_case=False).count() == len([n for n in names if n.endswith(".pdf")])
    assert files.file_manifest(spark, [str(root)]).filter("size_bytes = 0").count() == 1
    with pytest.raises(FileNotFoundError):
        files.list_files(spark, str(tmp_path / "none"))


def test_shell_patterns(spark):
    names = ["train-0.parquet", "train-a.parquet", "train-].parquet", "train-!.parquet", "a/train-1.parquet", "x^y", "x-y", "x\\y", "[ab", "a\nb", "a.b", "axb", "train-[0-9].parquet", "B", "x&y"]
    frame = spark.createDataFrame([(n,) for n in names], "path string")
    for pattern in ["train-[0-9].parquet", "train-[!0-9].parquet", "*train-[01].*", "train-[]].parquet", "train-[!]].parquet", "train-[a!].parquet", "x[\\^]y", "x[^-]y", "x[&&-]y", "[ab", "a?b", "a.b", "[a-z]*", "*", "", "x[!-]y", "b"]:
        got = {r.path for r in files.matching_any(frame, [pattern]).collect()}
        assert got == {n for n in names if fnmatch.fnmatchcase(n, pattern)}, pattern


def test_digests_of_files_beyond_two_gigabytes(spark, tmp_path):
    with (tmp_path / "large.bin").open("wb") as f:
        f.truncate((2 << 30) + 5)
    (tmp_path / "empty.bin").write_bytes(b"")
    sha = hashlib.sha256()
    for _ in range(512):
        sha.update(bytes(4 << 20))
    sha.update(bytes(5))
    got = {r.path.split("/")[-1]: (r.size_bytes, r.sha256) for r in files.file_hashes(spark, str(tmp_path)).collect()}
    assert got == {"large.bin": ((2 << 30) + 5, sha.hexdigest()), "empty.bin": (0, hashlib.sha256().hexdigest())}


def test_line_numbers_over_many_splits(spark, tmp_path):
    rng = random.Random(5)
    for name in "ab":
        lines = ["" if rng.random() < 0.1 else json.dumps({"i": i, "t": "x" * rng.randint(0, 90)}) for i in range(3000)]
        (tmp_path / f"{name}.jsonl").write_text("\n".join(lines) + "\n")
    (tmp_path / "empty.jsonl").write_text("")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        rows = jsonl.strict_jsonl(spark, str(tmp_path))
        assert rows.select("path").distinct().count() == 2
        assert spark.read.text(str(tmp_path)).select("_metadata.file_block_start").distinct().count() > 10
        assert rows.filter(F.variant_get("parsed", "$.i", "int") + 1 != F.col("line")).count() == 0 and rows.count() > 5000
        with (tmp_path / "b.jsonl").open("a") as f:
            f.write("{}\n" * 1000 + "{bad\n[]\n" + "{}\n" * 1000)
        with pytest.raises(Exception, match=r"invalid JSON at \S*b\.jsonl:4001"):
            jsonl.strict_jsonl(spark, str(tmp_path)).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


class Audits(scrapers.Scraper):
    """A user's scraper: an item a heading."""

    @classmethod
    def name(cls):
        return "audits_of_a_site"

    def items(self, uri, raw):
        assert b"never open this" not in raw
        for title in raw.decode().split("\n"):
            if title:
                yield {"title": title, "url": f"https://a/{title}", "pdf_links": [title], "source": "site"}


def test_a_users_scraper_runs_by_name(spark, tmp_path):
    for name, text in {"a/1.html": "x\ny", "a/2.html": "z", "b/c/3.HTML": "w", "b/4.txt": "never open this", "0.html": "r", "shut/5.html": "never open this"}.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text)
    assert scrapers.register(spark, Audits) == "audits_of_a_site"
    rows = spark.read.format("audits_of_a_site").option("path", str(tmp_path)).load()
    with pytest.raises(Exception, match="AssertionError"):
        rows.collect()
    some = scrapers.scraped(spark, Audits, str(tmp_path), folders=["a", "b/c", "", "none"])
    assert some.rdd.getNumPartitions() == 3
    assert sorted((r.folder, r.file, r.title, r.pdf_links) for r in some.collect()) == [("", "0.html", "r", ["r"]), ("a", "1.html", "x", ["x"]), ("a", "1.html", "y", ["y"]), ("a", "2.html", "z", ["z"]), ("b/c", "3.HTML", "w", ["w"])]
    assert some.filter("folder = 'a'").count() == 3 and some.count() == 5 and some.filter("folder = 'b/c'").count() == 1
    assert [r.title for r in scrapers.scraped(spark, Audits, str(tmp_path), ["a"], ["2.html"]).collect()] == ["z"]
    assert scrapers.scraped(spark, Audits, str(tmp_path), []).count() == 0
    assert [r.title for r in scrapers.scraped(spark, scrapers.Scraper, str(tmp_path), ["a"]).select("title").collect()] == [None, None]
