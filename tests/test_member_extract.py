"""Member extract job over invented feeds: three consecutive monthly snapshots."""

import os

import pytest

from snapflow.operators.checks import DataCheckError
from snapflow.operators.sinks import VersionedTable
from snapflow.plans import member_extract as ME


def _line(values: dict) -> str:
    return "|".join(values.get(c, "") for c in ME.FEED_COLUMNS)


def _member(hicn, **kw):
    base = {"MBR_HICN_NUM": hicn, "RPT_MO_KEY": "201909", "MBR_INDV_ID": "1001",
            "MBR_CRD_ID": "77", "MBR_LST_NM": "Doe", "MBR_FST_NM": "Jan", "MBR_DOB": "1950-02-03",
            "MBR_ADR_ZIP_FULL_CD": "55401-1234", "MBR_ANNL_CARE_VST_FLG": "1",
            "ASGN_PROV_ADR_ZIP_FULL_CD": "55401.0", "MSR_51_MAD_CURR_PDC": "0.855",
            "ROW_INSRT_DT": "2019-09-01 10:11:12.123", "SegmentID": "3"}
    base.update(kw)
    return base


def _land(folder, name, members, header_pad=False):
    hdr = "|".join((f" {c} " if header_pad else c) for c in ME.FEED_COLUMNS)
    with open(os.path.join(folder, name), "w") as fh:
        fh.write(hdr + "\n" + "\n".join(_line(m) for m in members) + "\n")
    return os.path.join(folder, name)


def _cfg(tmp, name):
    land = os.path.join(tmp, name)
    os.makedirs(land, exist_ok=True)
    return land, ME.Config(landing=land, stage=os.path.join(tmp, "stage"),
                           target=os.path.join(tmp, "target"))


def test_layout_widths():
    assert len(ME.FEED_COLUMNS) == 118
    assert len(ME.spec().target_cols()) == 127
    assert len(ME.spec().compare) == 117


def test_three_snapshots(spark, tmp):
    land, cfg = _cfg(tmp, "run1")
    _land(land, "Master_Extract_Data_Mart_201909.txt",
          [_member("A1"), _member("B2", MBR_DOB="bad"), _member("C3"),
           _member("D4", RPT_MO_KEY="")], header_pad=True)
    m1 = ME.run(spark, cfg, "2019-09-26 04:00:00")
    assert m1["insert"] == 3 and m1["rows"] == 3          # D4 has no report month (F1)
    t = {r["MBR_HICN_NUM"]: r for r in VersionedTable(spark, cfg.target).read().collect()}
    a = t["A1"]
    assert a["MBR_ADR_ZIP_FULL_CD"] == "554011234"
    assert a["ASGN_PROV_ADR_ZIP_FULL_CD"] == "55401"
    assert str(a["MSR_51_MAD_CURR_PDC"]) == "0.86"
    assert a["MBR_INDV_ID_STR"] == "1001" and a["MBR_ANNL_CARE_VST_FLG"] is True
    assert t["B2"]["MBR_DOB"] is None                      # lenient date
    assert a["MnR_Status"] == "Active" and a["MnR_SubStatus"] == "New" and a["CountOfFiles"] == 1

    # run 2: same A1 but new file name -> Updated (Q2); C3 missing -> Dropped; E5 new
    land2 = os.path.join(tmp, "run2"); os.makedirs(land2)
    cfg2 = ME.Config(landing=land2, stage=cfg.stage, target=cfg.target)
    _land(land2, "Master_Extract_Data_Mart_201910.txt",
          [_member("A1", RPT_MO_KEY="201910"), _member("B2", MBR_DOB="bad"), _member("E5")])
    m2 = ME.run(spark, cfg2, "2019-10-26 04:00:00")
    assert (m2["insert"], m2["update"], m2["drop"]) == (1, 2, 1)
    t = {r["MBR_HICN_NUM"]: r for r in VersionedTable(spark, cfg.target).read().collect()}
    assert t["A1"]["MnR_SubStatus"] == "Updated" and t["A1"]["CountOfFiles"] == 2
    assert t["A1"]["RPT_MO_KEY"] == 201909                 # insert-only (M5)
    assert t["C3"]["MnR_Status"] == "Inactive" and t["C3"]["DropDate"] is not None
    drop2 = t["C3"]["DropDate"]

    # run 3: C3 back -> reactivated, drop time cleared (Q11); A1 counter 3 (Q1 decision)
    land3 = os.path.join(tmp, "run3"); os.makedirs(land3)
    cfg3 = ME.Config(landing=land3, stage=cfg.stage, target=cfg.target)
    _land(land3, "Master_Extract_Data_Mart_201911.txt",
          [_member("A1", MBR_LST_NM="Roe"), _member("C3"), _member("E5")])
    ME.run(spark, cfg3, "2019-11-26 04:00:00")
    t = {r["MBR_HICN_NUM"]: r for r in VersionedTable(spark, cfg.target).read().collect()}
    assert t["C3"]["MnR_Status"] == "Active" and t["C3"]["DropDate"] is None
    assert t["A1"]["CountOfFiles"] == 3 and t["A1"]["MBR_LST_NM"] == "Roe"
    assert t["B2"]["MnR_SubStatus"] == "Dropped"
    assert drop2 is not None


def test_duplicate_key_fails_and_keeps_published(spark, tmp):
    land, cfg = _cfg(tmp, "dup")
    _land(land, "Master_Extract_Data_Mart_1.txt", [_member("A1"), _member("A1", MBR_FST_NM="X")])
    with pytest.raises(DataCheckError, match="A1"):
        ME.run(spark, cfg, "2019-09-26 04:00:00")
    assert VersionedTable(spark, cfg.target).read() is None


def test_zip_expanded_when_newer(spark, tmp):
    import zipfile
    land, cfg = _cfg(tmp, "zip")
    body = "|".join(ME.FEED_COLUMNS) + "\n" + _line(_member("Z9")) + "\n"
    with zipfile.ZipFile(os.path.join(land, "Master_Extract_Data_Mart_7.zip"), "w") as zf:
        zf.writestr("Master_Extract_Data_Mart_7.txt", body)
    m = ME.run(spark, cfg, "2019-09-26 04:00:00")
    assert m["file"] == "Master_Extract_Data_Mart_7.txt" and m["insert"] == 1


def test_newest_of_two_archives_is_loaded(spark, tmp):
    """The older archive is larger; only the newer one is opened."""
    import zipfile
    land, cfg = _cfg(tmp, "zips")
    head = "|".join(ME.FEED_COLUMNS) + "\n"
    for month, n, t in (("202401", 300, 1_700_000_000), ("202402", 2, 1_700_000_100)):
        path = os.path.join(land, f"Master_Extract_Data_Mart_{month}.zip")
        with zipfile.ZipFile(path, "w") as zf:
            zf.writestr(f"Master_Extract_Data_Mart_{month}.txt",
                        head + "".join(_line(_member(f"{month}-{i}")) + "\n" for i in range(n)))
        os.utime(path, (t, t))
    m = ME.run(spark, cfg, "2024-02-26 04:00:00")
    assert m["file"] == "Master_Extract_Data_Mart_202402.txt" and m["insert"] == 2


def test_quarantine_counted_in_stage_pass(spark, tmp):
    """R3 in the job: a line with a surplus field is quarantined and counted while staging."""
    land, cfg = _cfg(tmp, "bad")
    path = _land(land, "Master_Extract_Data_Mart_201910.txt", [_member("A1"), _member("B2")])
    with open(path, "a") as fh:
        fh.write(_line(_member("X9")) + "|surplus\n")
    m = ME.run(spark, cfg, "2019-10-26 04:00:00")
    assert m["staged"] == 2 and m["quarantined"] == 1 and m["insert"] == 2


def test_target_layout(spark):
    """K4: every rule's type and width fits the target's 127 columns."""
    from snapflow.operators import merge as M
    assert len(ME.TARGET.fields) == 127 and {f.name for f in ME.TARGET.fields} == set(ME.spec().target_cols())
    wide = {f.name for f in ME.TARGET.fields if "max_chars" in f.metadata and f.name in ME.TYPED_COLUMNS}
    assert wide == ME.fitted_columns()
    stage = spark.createDataFrame([], ", ".join(f"`{c}` string" for c in [*ME.FEED_COLUMNS, "Date_Ingested", "FileName"]))
    merged = M.empty_target(spark, ME.spec(), ME.target_source(stage).schema)
    assert ME.target_table(merged).columns == ME.TARGET.fieldNames()


def test_both_feeds_land_in_several_files(spark, tmp, monkeypatch):
    """The wide feed text is written by several tasks, however few bytes the snapshot shuffles."""
    from snapflow.plans import job_queries as J
    from conftest import SF
    landed = []

    class Landed(Exception):
        pass

    def stop(spark, cfg, as_of):
        landed.append(cfg.landing)
        raise Landed
    monkeypatch.setattr(ME, "run", stop)
    with pytest.raises(Landed):
        J.q_member_extract_job(spark, SF)
    feed = landed[0].replace("file:", "", 1) + "/Master_Extract_Data_Mart_1998.txt"
    assert sum(f.startswith("part-") for f in os.listdir(feed)) > 1


def test_one_compressed_feed_is_on_disk_at_a_time(spark, tmp, monkeypatch):
    """Each feed lands as compressed files of bounded rows when its run is due and is gone after it."""
    from snapflow.plans import job_queries as J
    seen, sf = [], os.path.join(tmp, "sf")
    spark.range(60).selectExpr("id c_custkey", "concat('Customer#', id) c_name", "cast(id % 25 as int) c_nationkey", "id * 1.5D c_acctbal",
                               "'BUILDING' c_mktsegment").write.parquet(f"{sf}/customer.parquet")
    spark.range(60).selectExpr("id o_orderkey", "id o_custkey", "'O' o_orderstatus", "timestamp_ntz'1997-09-01 00:00:00' o_orderdate",
                               "'1-URGENT' o_orderpriority").write.parquet(f"{sf}/orders.parquet")

    class Landed(Exception):
        pass

    def run(spark, cfg, as_of):
        root = os.path.dirname(cfg.landing.replace("file:", "", 1))
        files = [os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.startswith("part-")]
        assert all(f.endswith(".snappy") for f in files)
        texts = {f: [] for f in files}
        for r in spark.read.text(files).select("_metadata.file_path", "value").collect():
            texts["/" + r["file_path"].replace("file:", "", 1).lstrip("/")].append(r["value"])
        seen.append(({os.path.relpath(f, root).split("/")[0] for f in files}, list(texts.values())))
        if len(seen) == 2:
            raise Landed
    monkeypatch.setattr(ME, "run", run)
    monkeypatch.setattr(J, "FEED_FILE_ROWS", 2)
    with pytest.raises(Landed):
        J.q_member_extract_job(spark, sf)
    assert [folders for folders, _ in seen] == [{"landing1"}, {"landing2"}]
    for _, texts in seen:
        assert all(t[0].split("|") == ME.FEED_COLUMNS and len(t) <= 3 for t in texts)
        assert len(texts) > 4 * spark.sparkContext.defaultParallelism      # more files than tasks
        assert len({r for t in texts for r in t[1:]}) == sum(len(t) - 1 for t in texts) == 60


def test_no_refused_records_leave_an_empty_quarantine(spark, tmp):
    land, cfg = _cfg(tmp, "clean")
    _land(land, "Master_Extract_Data_Mart_201910.txt", [_member("A1")])
    m = ME.run(spark, cfg, "2019-10-26 04:00:00")
    kept = spark.read.parquet(m["quarantine"])
    assert m["quarantined"] == 0 and kept.count() == 0
    assert kept.dtypes == [("file_name", "string"), ("n_fields", "int"), ("line", "string")]
