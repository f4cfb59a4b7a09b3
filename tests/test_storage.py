"""Files and tables."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidewell.params import RunParams
from tidewell.plans.arrivals import arrived_files, file_arrival
from tidewell.session import shared_folder
from tidewell.sources import files, tables
from tidewell.streaming import arrivals as stream
from tidewell.streaming.arrivals import stream_file_facts, stream_facts


@pytest.fixture
def feed(tmp_path):
    folder = tmp_path / "in" / "client one"
    folder.mkdir(parents=True)
    contents = {"empty.txt": b"", "header.txt": b"a|b\n", "two.txt": b"a|b\n1|2\n3|4\n", "open.txt": b"a|b\n1|2\n3|4",
                "crlf.txt": b"a|b\r\n1|2\r\n", "mark.txt": b"\xef\xbb\xbfa|b\n1|2\n", "markopen.txt": b"\xef\xbb\xbfa|b\n1|2",
                "other.csv": b"x\ny\n", "blank.txt": b"a\n\n\n", "bytes.txt": "ä|ö\nü|ß\n".encode()}
    for name, data in contents.items():
        (folder / name).write_bytes(data)
    return str(tmp_path / "in"), contents


def expected(data):
    return max(data.count(b"\n") - 1, 0)


def test_file_stats(spark, feed):
    root, contents = feed
    got = {r.file_name: (r.folder, r.file_size, r.record_count) for r in files.file_stats(spark, root, "*.txt").collect()}
    assert got == {n: ("client one", len(d), expected(d)) for n, d in contents.items() if n.endswith(".txt")}


def test_large_files_are_split_and_still_counted(spark, tmp_path, monkeypatch):
    lines = b"header\n" + b"".join(b"row %d\n" % i for i in range(20000))
    (tmp_path / "big.txt").write_bytes(lines)
    (tmp_path / "open.txt").write_bytes(lines[:-1])
    for length in (20_000, len(lines), len(lines) - 1):
        monkeypatch.setattr(files, "RANGE", length)
        found = files.discover_files(spark, str(tmp_path))
        got = {r.file_name: r.record_count for r in files.with_counts(found, str(tmp_path)).collect()}
        assert got == {"big.txt": 20000, "open.txt": 19999}, length


def test_glob_to_regex(spark):
    rows = spark.createDataFrame([
        ("claims_1.txt", "claims_*.txt", True), ("claims_1.txtx", "claims_*.txt", False), ("a.b", "a?b", True),
        ("axb", "a.b", False), ("f(1).csv", "f(?).csv", True), ("x1", "x[0-9]", True), ("xa", "x[!0-9]", True)],
        "name string, pattern string, fits boolean")
    got = rows.where(F.rlike("name", files.glob_to_regex(F.col("pattern"))) != F.col("fits")).count()
    assert got == 0


def test_stream_counts_each_file_once(spark, feed, tmp_path):
    root, contents = feed
    target, seen = str(tmp_path / "facts"), str(tmp_path / "seen")

    def run():
        stream_file_facts(spark, root, target, seen, "*.txt").awaitTermination()
        return {r.file_name: r.record_count for r in spark.read.parquet(target).collect()}

    first = run()
    assert first == {n: expected(d) for n, d in contents.items() if n.endswith(".txt")}
    with open(os.path.join(root, "client one", "late.txt"), "wb") as late:
        late.write(b"h\n1\n2\n")
    assert run() == {**first, "late.txt": 2}
    assert spark.read.parquet(target).count() == len(first) + 1


def test_states(spark, tmp_path, table, values):
    path = str(tmp_path / "state")
    tables.save_state(table("k int", (1,), (2,)), path, 1)
    tables.save_state(tables.load_state(spark, path).where("k > 1"), path, 2)
    assert values(tables.load_state(spark, path)) == [(2,)]
    assert values(tables.load_state(spark, path, 1)) == [(1,), (2,)]
    tables.save_state(tables.load_state(spark, path).where("k > 5"), path, 3)
    assert values(tables.load_state(spark, path)) == []
    tables.save_state(table("k int", (9,)), path, 3)  # a retry of the run replaces its folder
    assert values(tables.load_state(spark, path)) == [(9,)]


def test_overwrite_touches_only_its_partitions(spark, tmp_path, table, values):
    path = str(tmp_path / "t")
    tables.overwrite(table("y int, v string", (1, "a"), (2, "b")), path, ["y"])
    tables.overwrite(table("y int, v string", (2, "c")), path, ["y"])
    assert values(tables.read_table(spark, path), "y", "v") == [(1, "a"), (2, "c")]


def test_arrival_queues_each_client_by_its_own_files(spark, feed, table, values):
    root, _ = feed
    when = datetime(2021, 3, 1, 6)
    config = table("pmd_client_id int, filetype string, filename string, filelocation string, filelocationdev string, "
                   "filelocationqa string, active boolean, trigger_eval_engine boolean, lastdatereceived timestamp_ntz, "
                   "unprocessed_filecount int",
                   (1, "claims", "t*.txt", "p", "client one", "q", True, True, None, 0),
                   (2, "claims", "t*.txt", "p", "client two", "q", True, True, None, 0),
                   (3, "claims", "*.csv", "p", "client one", "q", True, True, None, 0),
                   (4, "claims", "*.csv", "p", "client one", "q", False, True, None, 0))
    control = table("controlid int, pmdclientid int, runyear int, process int, process_ind boolean, filewatcherqueuedate timestamp_ntz",
                    (10, 1, 2021, 0, False, None), (11, 1, 2020, 0, False, None), (12, 2, 2021, 0, False, None),
                    (13, 3, 2021, 1, True, None), (14, 4, 2021, 0, False, None))
    history = table("pmd_client_id int, filetype string, filename string, filelocation string, active boolean, "
                    "lastdatereceived timestamp_ntz, unprocessed_filecount int",
                    (1, "claims", "t*.txt", "client one", True, datetime(2021, 3, 1, 1), 1))
    p = RunParams(client_id=0, run_year=2021, as_of=when, env="DEV")
    out = file_arrival(root, config, control, history, p)
    assert values(out.files, "pmd_client_id", "file_name", "record_count") == [(1, "two.txt", 2)]
    assert values(out.control, "controlid", "process", "filewatcherqueuedate") == [
        (10, 1, when), (11, 0, None), (12, 0, None), (13, 1, None), (14, 0, None)]
    assert values(out.history, "pmd_client_id", "lastdatereceived") == [(1, when)]  # same day: updated, not added
    assert "<td>client one</td>" in out.report.collect()[0][0]


def test_shared_folder_is_new_each_time(spark):
    assert shared_folder(spark) != shared_folder(spark)


def test_stream_reads_old_and_empty_files(spark, feed, tmp_path):
    root, contents = feed
    target, seen = str(tmp_path / "facts"), str(tmp_path / "seen")

    def run():
        stream_file_facts(spark, root, target, seen, "*.txt").awaitTermination()
        return {r.file_name: r.record_count for r in spark.read.parquet(target).collect()}

    first = run()
    assert first["empty.txt"] == 0
    folder = os.path.join(root, "client one")
    for name, days in (("twenty.txt", 20), ("years.txt", 2000)):
        path = os.path.join(folder, name)
        with open(path, "wb") as late:
            late.write(b"h\n1\n")
        when = os.path.getmtime(os.path.join(folder, "two.txt")) - days * 86400
        os.utime(path, (when, when))
    with open(os.path.join(folder, "nothing.txt"), "wb"):
        pass
    assert run() == {**first, "twenty.txt": 1, "years.txt": 1, "nothing.txt": 0}


def test_locations_of_any_depth(spark, tmp_path, table, values):
    for path in ("in/client78", "other/client78", "in/client78/sub", "in/client7"):
        (tmp_path / path).mkdir(parents=True, exist_ok=True)
        (tmp_path / path / "claims_1.txt").write_bytes(b"h\n1\n2\n")
    entries = table("pmd_client_id int, filetype string, filename string, filelocation string",
                    (78, "claims", "claims_*.txt", "in/client78"), (79, "claims", "*.txt", "in/client78/"), (80, "claims", "*", "absent"))
    found = arrived_files(str(tmp_path), entries)
    # The pattern's head must follow the location at once; a leading star reaches below it too.
    assert values(found, "pmd_client_id", "file_name", "record_count") == [
        (78, "claims_1.txt", 2), (79, "claims_1.txt", 2), (79, "claims_1.txt", 2)]


def test_only_watched_folders_are_listed(spark, tmp_path, table, monkeypatch):
    """No file index on the driver, and no folder opened but the watched ones."""
    for path in ("in/a/deep/er", "in/b", "unwatched/a/x", "unwatched/b"):
        (tmp_path / path).mkdir(parents=True)
        (tmp_path / path / "f.txt").write_bytes(b"")
    for k in range(2000):
        (tmp_path / "unwatched" / f"{k}.txt").write_bytes(b"")
    entries = table("pmd_client_id int, filetype string, filename string, filelocation string", (1, "c", "*.txt", "/in/a/"), (2, "c", "*", "in/b"))
    found = arrived_files(str(tmp_path), entries)
    assert found.inputFiles() == [] and "FileScan" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.pmd_client_id, r.folder, r.file_size, r.record_count) for r in found.collect()) == [(1, "in/a/deep/er", 0, 0), (2, "in/b", 0, 0)]
    opened = []

    class Store:
        def get_file_info(self, selector):
            opened.append(os.path.relpath(selector.base_dir, tmp_path))
            return local.get_file_info(selector)

    local, base = files.store_of(str(tmp_path))
    assert [i.base_name for i in files.walk(Store(), f"{base}/in/a")] == ["f.txt"]
    assert opened == ["in/a", "in/a/deep", "in/a/deep/er"]


def test_roots_as_uris(tmp_path):
    assert files.store_of(f"file://{tmp_path}/")[1] == files.store_of(f"file:{tmp_path}")[1] == files.store_of(str(tmp_path))[1] == str(tmp_path)


def test_hidden_and_odd_names(spark, tmp_path, values):
    for name in ("_SUCCESS", ".part.crc", "plain", "a+b %41ä.txt", "_x=1.txt"):
        (tmp_path / name).write_bytes(b"h\n1\n")
    assert values(files.file_stats(spark, str(tmp_path)), "file_name", "record_count") == [("_x=1.txt", 1), ("a+b %41ä.txt", 1), ("plain", 1)]


def test_file_that_fills_up_later(spark, tmp_path):
    root, target, seen = str(tmp_path / "in"), str(tmp_path / "facts"), str(tmp_path / "seen")
    os.makedirs(root)

    def put(name, data):
        with open(os.path.join(root, name), "wb") as f:
            f.write(data)

    def run():
        stream_file_facts(spark, root, target, seen).awaitTermination()
        return {r.file_name: r.record_count for r in stream_facts(spark, target).collect()}

    put("a.txt", b"h\n1\n")
    put("b.txt", b"")
    assert run() == {"a.txt": 1, "b.txt": 0}
    put("b.txt", b"h\n1\n2\n3\n")
    assert run() == {"a.txt": 1, "b.txt": 3}
    assert sorted((r.file_name, r.record_count) for r in spark.read.parquet(target).collect()) == [("a.txt", 1), ("b.txt", 3)]
    put("a.txt", b"h\n1\n2\n")
    put("c.txt", b"")
    assert run() == {"a.txt": 2, "b.txt": 3, "c.txt": 0}
    assert run() == {"a.txt": 2, "b.txt": 3, "c.txt": 0}
    # A repeated batch replaces what it wrote.
    before = sorted(map(str, spark.read.parquet(target).collect()))
    stream.write_facts(files.discover_files(spark, root), root, target, 3)
    assert sorted(map(str, spark.read.parquet(target).collect())) == before


def test_streamed_polls_equal_batch_polls(spark, tmp_path, table, values):
    root, target, seen = str(tmp_path / "in"), str(tmp_path / "state"), str(tmp_path / "seen")
    config = table("pmd_client_id int, filetype string, filename string, filelocation string, filelocationdev string, "
                   "filelocationqa string, active boolean, trigger_eval_engine boolean, lastdatereceived timestamp_ntz, "
                   "unprocessed_filecount int",
                   (1, "claims", "t*.txt", "p", "one", "q", True, True, None, 0), (2, "claims", "*.csv", "p", "two", "q", True, True, None, 0))
    control = table("controlid int, pmdclientid int, runyear int, process int, process_ind boolean, filewatcherqueuedate timestamp_ntz",
                    (10, 1, 2021, 0, False, None), (12, 2, 2021, 0, False, None))
    history = table("pmd_client_id int, filetype string, filename string, filelocation string, active boolean, "
                    "lastdatereceived timestamp_ntz, unprocessed_filecount int")
    p = RunParams(client_id=0, run_year=2021, as_of=datetime(2021, 3, 1), env="DEV")
    stream.start_tables(target, config, control, history)
    polls = [({"one/t1.txt": b""}, datetime(2021, 3, 1, 6)), ({"one/t1.txt": b"h\n1\n"}, datetime(2021, 3, 1, 9)),
             ({"two/x.csv": b"h\n1\n2\n", "one/t2.txt": b"h\n"}, datetime(2021, 3, 2, 6)), ({}, datetime(2021, 3, 2, 9))]
    names = {"files": ("pmd_client_id", "file_name", "file_size", "record_count"), "config": config.columns, "control": control.columns,
             "history": history.columns, "report": ("report",)}
    state = (config, control, history)
    for k, (puts, when) in enumerate(polls):
        for path, data in puts.items():
            os.makedirs(os.path.dirname(os.path.join(root, path)), exist_ok=True)
            with open(os.path.join(root, path), "wb") as f:
                f.write(data)
        want = file_arrival(root, *state, RunParams(client_id=0, run_year=2021, as_of=when, env="DEV"))
        state = tuple(table(df.schema, *df.collect()) for df in (want.config, want.control, want.history))
        stream.stream_arrivals(spark, root, target, seen, p, lambda _, when=when: when).awaitTermination()
        if k == 2:  # a batch that is repeated changes nothing
            stream.poll_once(spark, root, target, k, RunParams(client_id=0, run_year=2021, as_of=when, env="DEV"))
        for name, columns in names.items():
            assert values(stream.arrivals(spark, target, name), *columns) == values(getattr(want, name), *columns), (k, name)
    assert [r.batch_id for r in stream.finished(spark, target).orderBy("batch_id").collect()] == [0, 1, 2, 3]
    # Contents are counted once: the facts of a batch hold what was counted or reused, by the same identity.
    assert stream.arrivals(spark, target, "files").count() == 3


def test_state_keeps_its_own_columns_and_marker(spark, tmp_path, table, values):
    path = str(tmp_path / "state")
    tables.save_state(table("k int", (1,)), path, 1)
    tables.save_state(table("k int, flag boolean", (1, True)), path, 2)
    assert tables.load_state(spark, path).columns == ["k", "flag"]
    assert tables.load_state(spark, path, 1).columns == ["k"]
    # A run that died before its marker was written is not the newest.
    tables.overwrite(table("k int", (9,)), f"{path}/states/state_run=3")
    assert values(tables.load_state(spark, path)) == [(1, True)]


def test_history_of_a_repeated_run(spark, tmp_path, table, values):
    path = str(tmp_path / "history")
    for run, rows in ((1, [(1,), (2,)]), (2, [(3,)]), (2, [(3,)])):
        tables.write_run(table("k int", *rows), path, run)
    assert values(spark.read.parquet(path), "history_run", "k") == [(1, 1), (1, 2), (2, 3)]


def test_partitions_of_other_runs_keep_their_files(spark, tmp_path, table, values):
    path, schema = str(tmp_path / "t"), "k string, client bigint, y int"

    def names(client, y):
        found = tables.load_partitions(spark, path).where(f"client = {client} and y = {y}" if y is not None else f"client = {client} and y is null")
        return sorted({r[0] for r in found.select(F.input_file_name()).collect()})

    tables.replace_partitions(table(schema, ("a", 1, 2020), ("b", 1, 2021), ("c", 2, 2020), ("d", 2, None)), path, 0, ["client", "y"])
    before = {key: names(*key) for key in ((1, 2021), (2, 2020), (2, None))}
    now = tables.load_partitions(spark, path, 1).where("client = 1 and y = 2020").selectExpr("upper(k) as k", "client", "y")
    added = table(schema, ("e", 1, 2021))
    for _ in range(2):  # a retry reads the table before the run, and leaves the same
        tables.replace_partitions(now.unionByName(added), path, 1, ["client", "y"], {"client": 1, "y": 2020})
        assert values(tables.load_partitions(spark, path), "k", "client", "y") == [
            ("A", 1, 2020), ("b", 1, 2021), ("c", 2, 2020), ("d", 2, None), ("e", 1, 2021)]
    assert [names(*key) for key in ((2, 2020), (2, None))] == [before[2, 2020], before[2, None]]
    assert set(before[1, 2021]) < set(names(1, 2021))
    # A run that died before its list was written is not seen; an emptied partition is gone; new columns are added.
    table(schema, ("x", 9, 1)).write.partitionBy("client", "y").parquet(f"{path}/parts/state_run=2")
    assert tables.load_partitions(spark, path).count() == 5
    tables.replace_partitions(table(schema + ", more int", ("f", 3, 2020, 7)), path, 3, ["client", "y"], {"client": 1, "y": 2021})
    rows = tables.load_partitions(spark, path)
    assert rows.columns == ["k", "client", "y", "more"] and dict(rows.dtypes)["client"] == "bigint"
    assert values(rows, "k", "more") == [("A", None), ("c", None), ("d", None), ("f", 7)]
    assert values(tables.load_partitions(spark, path, before=1), "k") == [("a",), ("b",), ("c",), ("d",)]
    with pytest.raises(ValueError):
        tables.load_partitions(spark, path, before=0)


def test_table_of_no_partitions(spark, tmp_path, table):
    path = str(tmp_path / "t")
    tables.replace_partitions(table("k string, y int"), path, 0, ["y"])
    assert tables.load_partitions(spark, path).columns == ["k", "y"] and tables.load_partitions(spark, path).count() == 0
    tables.replace_partitions(table("k string, y int", ("a", 1)), path, 1, ["y"], {"y": 1})
    assert tables.load_partitions(spark, path).count() == 1


def test_partition_names_of_any_text(spark, tmp_path, table, values):
    path = str(tmp_path / "t")
    rows = [(k, name) for k, name in enumerate(["a b", "x/y", "50%", "ä=ö", "p+q", ""])]
    tables.replace_partitions(table("k int, name string", *rows), path, 0, ["name"])
    assert [k for k, in values(tables.load_partitions(spark, path), "k")] == [k for k, _ in rows]
    tables.replace_partitions(table("k int, name string"), path, 1, ["name"], {"name": "x/y"})
    assert [k for k, in values(tables.load_partitions(spark, path), "k")] == [0, 2, 3, 4, 5]
