"""File discovery: the newest feed may be one file or a folder of part files."""

import os
import time

from snapflow.sources import files


def _touch(path, text, mtime):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)
    os.utime(path, (mtime, mtime))


def test_latest_feed_file_or_folder(spark, tmp):
    land = os.path.join(tmp, "landing")
    now = time.time()
    _touch(os.path.join(land, "Feed_201908.txt"), "a\n", now - 300)              # file feed
    _touch(os.path.join(land, "Feed_201909.txt", "part-0.csv"), "a\n", now - 200)  # folder feed
    _touch(os.path.join(land, "Feed_201909.txt", "part-1.csv"), "a\n", now - 100)
    _touch(os.path.join(land, "Other_201912.txt"), "a\n", now)                   # not a feed
    path, name = files.latest_feed(spark, land, "Feed_*.txt")
    assert name == "Feed_201909.txt" and path.endswith("/landing/Feed_201909.txt")
    _touch(os.path.join(land, "Feed_201910.txt"), "a\n", now - 50)               # newer file
    assert files.latest_feed(spark, land, "Feed_*.txt")[1] == "Feed_201910.txt"
    assert files.latest_feed(spark, land, "Nothing_*.txt") is None


def _put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        fh.write(text)


def test_quoted_fields(spark, tmp):
    from snapflow.sources.delimited import read_delimited
    _put(tmp, "f.txt", 'a|b|c\n1|"x|y"|2\n3|"say ""hi"""tail|\n4|in "the" middle|""\n5|"a|b|c\n6|x|y|z\n')
    r = read_delimited(spark, tmp, ["a", "b", "c"], file_col=None)
    assert sorted(map(tuple, r.good.collect())) == [
        ("1", "x|y", "2"), ("3", 'say "hi"tail', ""), ("4", 'in "the" middle', "")]
    assert sorted(x["line"] for x in r.quarantine.collect()) == ['5|"a|b|c', "6|x|y|z"]


def test_quotes_agree_with_pandas(spark, tmp):
    import io
    import random
    import pandas as pd
    from snapflow.sources.delimited import read_delimited
    rnd = random.Random(3)
    fields = ["x", "", '"p|q"', '"a""b"', 'm"id', '""', '"t"ail', '"|"', " s "]
    lines = ["a|b|c"] + ["|".join(rnd.choices(fields, k=3)) for _ in range(300)]
    lines = [ln for ln in lines if ln.strip("|")]
    _put(tmp, "f.txt", "\n".join(lines) + "\n")
    want = pd.read_csv(io.StringIO("\n".join(lines)), sep="|", dtype=str, keep_default_na=False)
    got = read_delimited(spark, tmp, ["a", "b", "c"], file_col=None, strip=False)
    assert sorted(map(tuple, got.good.collect())) == sorted(want.itertuples(index=False, name=None))
    assert got.quarantine.isEmpty()


def test_header_order_differs_by_file(spark, tmp):
    from snapflow.sources.delimited import read_delimited
    _put(tmp, "f1.txt", "a|b\n1|x\n2|y|surplus\n")
    _put(tmp, "f2.txt", "b|a\nz|3\n")
    _put(tmp, "f3.txt", "a|b\n4\n")
    r = read_delimited(spark, tmp, ["a", "b"])
    assert sorted((x["a"], x["b"], x["FileName"]) for x in r.good.collect()) == [
        ("1", "x", "f1.txt"), ("3", "z", "f2.txt"), ("4", None, "f3.txt")]
    assert [x["line"] for x in r.quarantine.collect()] == ["2|y|surplus"]


def test_missing_texts(spark, tmp):
    from snapflow.sources.delimited import read_delimited
    _put(tmp, "f.txt", "a\tb\nNA\tN/A\nNULL\tx\n\tnone\n")
    got = read_delimited(spark, tmp, ["a", "b"], sep="\t", nan_text=True, blank_as_null=True, file_col=None).good
    assert sorted(map(tuple, got.collect())) == [("nan", "nan"), ("nan", "none"), ("nan", "x")]


def test_written_feed_reads_back(spark, tmp):
    from snapflow.sources.delimited import read_delimited, write_delimited
    rows = [("1", "x|y"), ("2", 'q"r'), ("3", '"'), ("4", "plain"), ("5", "")]
    write_delimited(spark.createDataFrame(rows, "k string, v string"), os.path.join(tmp, "f"))
    got = read_delimited(spark, os.path.join(tmp, "f"), ["k", "v"], file_col=None).good
    assert sorted(map(tuple, got.collect())) == rows


def test_compressed_feed_reads_back(spark, tmp):
    """Compressed files of bounded rows, each with its header; line breaks inside quotes too."""
    from snapflow.sources.delimited import read_delimited, write_delimited
    rows = [("1", "x|y"), ("2", 'q"r'), ("3", "two\nlines"), ("4", "plain"), ("5", "")]
    for codec, suffix in (("gzip", ".gz"), ("snappy", ".snappy")):
        path = os.path.join(tmp, codec)
        write_delimited(spark.createDataFrame(rows, "k string, v string").coalesce(1), path, compression=codec, rows_per_file=2)
        parts = [f for f in os.listdir(path) if f.startswith("part-")]
        assert len(parts) == 3 and all(f.endswith(suffix) for f in parts)
        got = read_delimited(spark, path, ["k", "v"], file_col=None).good
        assert sorted(map(tuple, got.collect())) == rows


def test_latest_feed_below_folder_of_same_name(spark, tmp):
    land = os.path.join(tmp, "land", "x", "land")
    _put(land, "Feed_1.txt", "a\n1\n")
    assert files.latest_feed(spark, land, "Feed_*.txt")[1] == "Feed_1.txt"


def test_newest_archive_only(spark, tmp):
    import zipfile
    from snapflow.sources import archive
    for name, n, t in (("Feed_202401", 5000, 1_700_000_000), ("Feed_202402", 3, 1_700_000_100)):
        path = os.path.join(tmp, name + ".zip")
        with zipfile.ZipFile(path, "w") as zf:
            zf.writestr(name + ".txt", "a\n" + "1\n" * n)
        os.utime(path, (t, t))
    out = archive.expand_newest(spark, tmp, "Feed_*.zip", "Feed_*.txt")
    assert out.endswith("/Feed_202402.txt") and spark.read.text(out).count() == 4
    assert not os.path.exists(os.path.join(tmp, "Feed_202401.txt"))
    assert archive.expand_newest(spark, tmp, "Feed_*.zip", "Feed_*.txt") is None
    assert files.latest_feed(spark, tmp, "Feed_*.txt")[1] == "Feed_202402.txt"


def _as_pandas(text, sep, columns):
    import io
    import pandas as pd
    return sorted(pd.read_csv(io.StringIO(text), sep=sep, dtype=str, keep_default_na=False, usecols=columns)[columns].itertuples(index=False, name=None))


def test_line_breaks_inside_quotes_across_ranges(spark, tmp):
    """Ranges of a few bytes: records, some of many lines, cross their borders; nothing is quarantined."""
    import random
    from snapflow.sources.delimited import read_delimited
    rnd = random.Random(8)
    fields = ["x", "", '"p|q"', '"a""b"', 'm"id', '""', '"t"ail', '"two\nlines"', '"\n"', '"a|\n""\n|b"tail', '"' + "long\n" * 40 + '"', "plain text"]
    for name in ("f1.txt", "f2.txt"):
        body = [r for r in ("|".join(rnd.choices(fields, k=3)) for _ in range(60)) if r.strip("|")]
        _put(os.path.join(tmp, "feed"), name, "\n".join(["a|b|c", *body]) + "\n")
    _put(os.path.join(tmp, "feed"), "g.txt", "c|a|b\nz|1|\n\"y\ny\"|2|w\n")
    want = []
    for name in ("f1.txt", "f2.txt"):
        with open(os.path.join(tmp, "feed", name)) as fh:
            want += _as_pandas(fh.read(), "|", ["a", "b", "c"])
    want += [("1", "", "z"), ("2", "w", "y\ny")]
    key = lambda r: tuple((x is not None, x) for x in r)
    for size in ("256b", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1b")
        try:
            got = read_delimited(spark, os.path.join(tmp, "feed"), ["a", "b", "c"], file_col=None, strip=False)
            assert sorted(map(tuple, got.good.collect()), key=key) == sorted(want, key=key)
            assert got.quarantine.isEmpty()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")


def test_quote_without_end_loads_nothing_after_it(spark, tmp):
    from snapflow.sources.delimited import read_delimited
    _put(tmp, "f.txt", 'a|b\n1|x\n2|"in\nside"\n3|"never closed\n4|y\n' + "5|z\n" * 30)
    _put(tmp, "g.txt", "a|b\n6|w\n")
    for size in ("64b", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1b")
        try:
            r = read_delimited(spark, tmp, ["a", "b"], file_col=None)
            assert sorted(map(tuple, r.good.collect())) == [("1", "x"), ("2", "in\nside"), ("6", "w")]
            assert sorted(x["line"] for x in r.quarantine.collect()) == ['3|"never closed', "4|y", *["5|z"] * 30]
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")


def test_record_limit_and_moved_ranges(spark, tmp):
    import pytest
    from snapflow.sources import records
    _put(tmp, "f.txt", 'a|b\n1|"' + "x\n" * 500 + '"\n')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    try:
        lines = records.lines_of(spark, tmp)
        summary = records.range_summary(lines, "|", ["a", "b"]).collect()
        assert len(summary) > 5
        with pytest.raises(Exception, match="more than 300 characters"):
            records.joined_records(lines, spark.createDataFrame(summary), "|", 300).collect()
        with pytest.raises(Exception, match="RangesMoved"):
            records.joined_records(lines, spark.createDataFrame(summary[:3]), "|").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_workbook_rows_leave_in_batches(spark, tmp):
    """A batch of many workbooks: the largest list of rows held is one output batch; shared strings by number."""
    import pyarrow as pa
    from snapflow.plans.source_queries import _xlsx_bytes
    from snapflow.sources import workbook
    books = [_xlsx_bytes(["a", "b"], [[i, f"t{k}-{i}"] for i in range(230)], False) for k in range(6)]
    batch = pa.RecordBatch.from_arrays([pa.array([f"b{k}.xlsx" for k in range(6)]), pa.array(books, pa.binary())], names=["path", "content"])
    out = list(workbook._parser(["a", "b"], rows=100)([batch]))
    assert max(b.num_rows for b in out) == 100 and sum(b.num_rows for b in out) == 6 * 230
    assert sorted(x for b in out for x in b.column("b").to_pylist()) == sorted(f"t{k}-{i}" for k in range(6) for i in range(230))
    import io
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    texts = ["", "x", "é€", "two parts", "last"]
    xml = f'<sst {ns}>' + "".join(f"<si><t>{t}</t></si>" if t != "two parts" else "<si><r><t>two </t></r><r><t>parts</t></r></si>" for t in texts) + "</sst>"
    shared = workbook.SharedStrings()
    shared.read(io.BytesIO(xml.encode()))
    assert [shared.text(i) for i in range(5)] == texts


def test_archive_members_are_partitions(spark, tmp, monkeypatch):
    """The member data source gives the lines of the other path; a member is read in pieces, whatever its size."""
    import zipfile
    from snapflow.sources import archive
    paths = []
    for k in range(2):
        paths.append(os.path.join(tmp, f"Feed_{k} x.zip"))
        with zipfile.ZipFile(paths[-1], "w", zipfile.ZIP_DEFLATED) as zf:
            zf.writestr("dir/", "")
            for m in range(3):
                zf.writestr(f"dir/m{m}.txt", "".join(f"line {k} {m} {i}\r\n" for i in range(m * 700)) + ("no break" if m == 1 else ""))
    zf = spark.read.format("binaryFile").load(tmp)
    uris = [r["path"] for r in zf.select("path").collect()]
    parts = archive.expand_members(spark, uris, rows=100)
    assert parts.rdd.getNumPartitions() == 6
    key = lambda rs: sorted((r["member"], r["line_no"], r["line"]) for r in rs)
    assert key(parts.collect()) == key(archive.expand(zf).collect()) and parts.count() == 2 * (700 + 1 + 1400)
    batches = list(archive._MemberReader([], 100).read(archive.Member("file:" + paths[0], "dir/m2.txt")))
    assert [b.num_rows for b in batches] == [100] * 14
    monkeypatch.setattr(archive, "LARGE", 1)
    with zipfile.ZipFile(os.path.join(tmp, "Big_1.zip"), "w") as one:
        one.writestr("Big_1.txt", "a\n1\n2\n")
    out = archive.expand_newest(spark, tmp, "Big_*.zip", "Big_*.txt")
    assert sorted(r["value"] for r in spark.read.text(out).collect()) == ["1", "2", "a"]
