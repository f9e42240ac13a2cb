import os

import pytest

from casegrid.sources.tables import read_or_empty, reload_table
from casegrid.sources.versions import read_table
from casegrid.sources.text_csv import read_text_csv, resolve_columns, snake_case_columns


def test_snake_case_columns():
    assert snake_case_columns(["Establishment Name", "NAICS-Code", "Days Away From Work", "id"]) == [
        "establishment_name", "naics_code", "days_away_from_work", "id"]


def test_snake_case_rejects_empty_and_collisions():
    with pytest.raises(ValueError):
        snake_case_columns(["???"])
    with pytest.raises(ValueError):
        snake_case_columns(["A B", "a-b"])


def test_resolve_columns_case_insensitive(spark):
    df = spark.createDataFrame([("x", 1)], "NEW_NAR_WHAT_HAPPENED string, other int")
    assert resolve_columns(df, ["new_nar_what_happened", "missing"]) == ["NEW_NAR_WHAT_HAPPENED"]
    with pytest.raises(ValueError):
        resolve_columns(spark.createDataFrame([(1, 2)], "foo int, bar int"), ["NEW_NAR_WHAT_HAPPENED"])


def test_read_text_csv_cp1252_multiline_tokens(spark, tmp_dir):
    path = os.path.join(tmp_dir, "cases.csv")
    body = ('ID,Zip Code,Narrative,Cost\r\n'
            '1,02139,"said ""stop""\nthen fell",\x80 5\r\n'
            '2,N/A,"bad byte \x81 here",NA\r\n').encode("latin-1")
    with open(path, "wb") as fh:
        fh.write(body)
    df = read_text_csv(spark, path)
    assert df.columns == ["id", "zip_code", "narrative", "cost"]
    assert all(f.dataType.simpleString() == "string" for f in df.schema.fields)
    rows = sorted(tuple(r) for r in df.collect())
    assert rows[0] == ("1", "02139", 'said "stop"\nthen fell', "€ 5")
    assert rows[1] == ("2", None, "bad byte � here", None)


def test_reload_is_idempotent(spark, tmp_dir):
    df = spark.createDataFrame([(1,), (2,), (3,)], "col_a int")
    path = os.path.join(tmp_dir, "raw")
    assert reload_table(df, path) == 3
    assert reload_table(df, path) == 3
    assert read_table(spark, path).count() == 3


def test_missing_table_reads_empty(spark, tmp_dir):
    from casegrid.operators.enrich import ENRICHMENT_SCHEMA
    df = read_or_empty(spark, os.path.join(tmp_dir, "nope"), ENRICHMENT_SCHEMA)
    assert df.count() == 0 and df.schema == ENRICHMENT_SCHEMA


def test_write_then_read_text_csv_round_trip(spark, tmp_dir):
    from casegrid.sources.text_csv import write_text_csv
    df = spark.createDataFrame([("1", 'a "quoted"\nline', "\x80"), ("2", None, "x")], "ID string, Note string, B string")
    path = os.path.join(tmp_dir, "out")
    write_text_csv(df, path, encoding="ISO-8859-1")
    back = sorted(tuple(r) for r in read_text_csv(spark, path).collect())
    assert back == [("1", 'a "quoted"\nline', "€"), ("2", None, "x")]


def export(tmp_dir, **files):
    os.makedirs(tmp_dir, exist_ok=True)
    for name, body in files.items():
        with open(os.path.join(tmp_dir, f"{name}.csv"), "w") as fh:
            fh.write(body)
    return tmp_dir


def test_files_with_other_column_orders_keep_their_fields(spark, tmp_dir):
    path = export(tmp_dir, a="id,name,zip\n1,x,07\n2,\"y\nz\",08\n", b="zip,id,name\n09,7,q\n", c="")
    got = sorted(tuple(r) for r in read_text_csv(spark, path, "UTF-8").select("id", "name", "zip").collect())
    assert got == [("1", "x", "07"), ("2", "y\nz", "08"), ("7", "q", "09")]


def test_ragged_rows_fail_or_are_kept_apart(spark, tmp_dir):
    path = export(tmp_dir, a="id,name\n1,x\n2,y,extra\n3\n4,z\n")
    with pytest.raises(Exception):  # noqa: B017 - Spark's own error
        read_text_csv(spark, path, "UTF-8").collect()
    with pytest.raises(Exception):  # noqa: B017 - also when no column is read
        read_text_csv(spark, path, "UTF-8").select("id").collect()
    rows = sorted((tuple(r) for r in read_text_csv(spark, path, "UTF-8", malformed="keep").collect()), key=str)
    assert rows == [("1", "x", None), ("4", "z", None), (None, None, "2,y,extra"), (None, None, "3")]


def test_files_that_disagree_are_an_error(spark, tmp_dir):
    with pytest.raises(ValueError):
        read_text_csv(spark, export(os.path.join(tmp_dir, "x"), a="id,name\n1,x\n", b="id,town\n1,x\n"))
    with pytest.raises(ValueError):
        read_text_csv(spark, export(os.path.join(tmp_dir, "y"), a=""))


def test_sample_as_csv(spark, tmp_dir):
    from casegrid.sources.text_csv import sample_as_csv
    df = spark.createDataFrame([(str(k), f"text, {k}" if k % 2 else None) for k in range(20)], "id string, nar string")
    got = sample_as_csv(df, ["nar"], 4, 1, "id", os.path.join(tmp_dir, "s")).collect()
    assert len(got) == 4 and all(r.nar == f"text, {r.id}" for r in got)
    with pytest.raises(ValueError):
        sample_as_csv(df.where("nar is null"), ["nar"], 4, 1, "id", os.path.join(tmp_dir, "t"))


def test_a_cluster_needs_a_shared_checkpoint_folder():
    from casegrid.session import ensure_checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        def __init__(self, master):
            self.master, self.dir = master, None

        def getCheckpointDir(self):
            return self.dir

        def setCheckpointDir(self, path):
            self.dir = path

    class Session:
        def __init__(self, master):
            self.sparkContext, self.conf = Context(master), Conf()

    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://https://host"):
        with pytest.raises(RuntimeError):
            ensure_checkpoint_dir(Session(master))
    for master in ("local", "local[4]", "local[*]"):
        assert ensure_checkpoint_dir(Session(master))


def messy(rng, n, end):
    """A file whose fields hold quotes, commas and line breaks, and the rows in it."""
    words = ["a", "é", 'say ""x""', "b,c", "two\nlines", "\r\n", '""', "", " z ", "\n\n\n", "long " * 9]
    lines, rows = ["id,Note,Other"], []
    for k in range(n):
        note, other = ("".join(rng.choice(words) for _ in range(rng.randrange(0, 4))) for _ in range(2))
        rows.append((str(k), note.replace('""', '"'), other.replace('""', '"')))
        lines.append(f'{k},"{note}","{other}"')
    return end.join(lines) + end * rng.randrange(0, 3), rows


@pytest.mark.parametrize("size", [7, 40, 333])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_a_large_file_is_read_in_ranges(spark, tmp_dir, size, end):
    """Ranges of any size, with bounds inside quotes and line breaks, give the rows of the whole file."""
    import random
    rng = random.Random(size)
    path, want = os.path.join(tmp_dir, "in"), []
    os.makedirs(path)
    for name in ("a", "b"):
        text, rows = messy(rng, 60, end)
        want += rows
        with open(os.path.join(path, f"{name}.csv"), "w", newline="") as f:
            f.write(text)
    conf = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        frame = read_text_csv(spark, path, "UTF-8", tokens=None, split=True)
        assert frame.columns == ["id", "note", "other"]
        got = sorted(tuple(x or "" for x in r) for r in frame.collect())
        assert spark.read.text(path).rdd.getNumPartitions() > 10
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == sorted(want)
    # in files whose records end in CRLF, the whole-file reader turns a CRLF inside quotes into a line feed
    plain = lambda rows: sorted(tuple((x or "").replace("\r\n", "\n") for x in r) for r in rows)
    assert plain(read_text_csv(spark, path, "UTF-8", tokens=None).collect()) == plain(want)


def test_ranges_keep_column_orders_and_malformed_rows(spark, tmp_dir):
    path = export(tmp_dir, a="id,name\n1,x\n2,y,extra\n3\n4,z\n", b='name,id\n"q\nr",7\n', c="")
    with pytest.raises(Exception):  # noqa: B017 - Spark's own error
        read_text_csv(spark, path, "UTF-8", split=True).collect()
    rows = [sorted((tuple(r) for r in read_text_csv(spark, path, "UTF-8", malformed="keep", split=s).select(
        "id", "name", "malformed_row").collect()), key=str) for s in (False, True)]
    assert rows[0] == rows[1] and ("7", "q\nr", None) in rows[1] and (None, None, "3") in rows[1]


def test_headers_are_read_without_the_rest(spark, tmp_dir):
    """Also of compressed files, and of files that start with blank lines."""
    import gzip

    from casegrid.sources.text_csv import header_groups
    path = export(tmp_dir, a="\n  \nid,name\n1,x\n")
    with gzip.open(os.path.join(path, "b.csv.gz"), "wt") as f:
        f.write("name,id\n" + "y,2\n" * 1000)
    before = spark.sparkContext.statusTracker().getJobIdsForGroup()
    groups = header_groups(spark, path, "cp1252")
    assert spark.sparkContext.statusTracker().getJobIdsForGroup() == before  # no job read them
    assert {h: [os.path.basename(f) for f in fs] for h, fs in groups.items()} == {
        ("id", "name"): ["a.csv"], ("name", "id"): ["b.csv.gz"]}
    assert read_text_csv(spark, path).count() == 1001


@pytest.mark.parametrize("split", [False, True])
def test_lines_of_spaces_before_the_header(spark, tmp_dir, split):
    path = export(tmp_dir, a="\n  \nid,name\n1,x\n2,\"y\nz\"\n", b="id,name\n3,w\n")
    rows = read_text_csv(spark, path, split=split).collect()
    assert sorted(map(tuple, rows)) == [("1", "x"), ("2", "y\nz"), ("3", "w")]
