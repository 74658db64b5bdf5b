"""Super-users job over invented feeds."""

import datetime as dt
import os

import pytest

from snapflow.operators.checks import DataCheckError
from snapflow.operators.sinks import VersionedTable
from snapflow.plans import super_users as SU
from snapflow.sources.workbook import read_workbooks
from xlsx_util import write_xlsx

AS_OF = "2019-09-26 04:00:00"


def _frame(spark, cols, rows, as_of=AS_OF, file="f.txt"):
    full = cols + ["date_ingested", "FileName"]
    data = [[r.get(c) for c in cols] + [as_of, file] for r in rows]
    df = spark.createDataFrame(data, ", ".join(f"`{c}` string" for c in full))
    return df.withColumn("date_ingested", df["date_ingested"].cast("timestamp_ntz"))


def _feeds(spark, ei_rows, aco_rows, mr_rows, cs_rows):
    cs = _frame(spark, SU.CS_COLUMNS + ["file_origin"], cs_rows)
    return (_frame(spark, SU.EI_COLUMNS, ei_rows), _frame(spark, SU.EI_ACO_COLUMNS, aco_rows),
            _frame(spark, SU.MR_COLUMNS, mr_rows), cs)


EI = [
    {"MBR_ID": "E1", "indv_id": "100", "pred_flag": "0", "MBR_FST_NM": "Ann", "MBR_LST_NM": "Lee",
     "dob": "1960-01-02", "MBR_ZIP_CD": "55401", "pred": "0.5", "MBR_ST_ABBR_CD": "nan"},
    {"MBR_ID": "E2", "indv_id": "100", "pred_flag": "1", "MBR_FST_NM": "Ann", "MBR_LST_NM": "Lee",
     "dob": "1960-01-02", "MBR_ZIP_CD": "55401", "pred": "0.7", "pred_cutoff": ""},
    {"MBR_ID": "E3", "indv_id": "nan", "pred_flag": "1", "MBR_FST_NM": "Bo", "dob": "nan"},
    {"MBR_ID": "E4", "indv_id": "nan", "pred_flag": "1", "MBR_FST_NM": "Cy"},
]
ACO = [{"MBR_ID": "E2", "aco_flag": "1", "group_nm": "G1", "referral": "Y"}]
MR = [{"hicn": "M1", "GPS_FIRST_NAME": "ANN", "GPS_LAST_NAME": "LEE", "bth_dt": "1960-01-02",
       "gps_zip_cd": "554011234", "pred_flag": "1", "CHF_eng": "1"},
      {"hicn": "M1", "GPS_FIRST_NAME": "ANN", "GPS_LAST_NAME": "LEE", "bth_dt": "1960-01-02",
       "gps_zip_cd": "554011234", "pred_flag": "1", "CHF_eng": "1"}]
CS = [{"Member_Key": "C1", "Member_First_Name": "Di", "Member_DOB": "1970-05-06",
       "pred_model_flag": "1", "file_origin": "mcd"},
      {"Member_Key": "C2", "Member_First_Name": "Ed", "pred_model_flag": "0", "file_origin": "xx"}]


def test_source_rows(spark):
    src = SU.build_source(*_feeds(spark, EI, ACO, MR, CS))
    rows = {r["Member_ID"]: r for r in src.collect()}
    assert set(rows) == {"E2", "E3", "E4", "M1", "C1", "C2"}     # W1, Q5 keep, A1 distinct
    e2, m1 = rows["E2"], rows["M1"]
    assert e2["ACO_Flag"] is True and e2["GroupName"] == "G1" and e2["Is_PSU"] is True
    assert e2["Member_Key"] == m1["Member_Key"] and e2["CountOf_LOB"] == 2   # X17, W2
    assert len(e2["Member_Key"]) == 32 and e2["Member_Key"] == e2["Member_Key"].upper()
    assert m1["MemberZipCd"] == "55401" and m1["MemberZipPlus4Cd"] == "1234"
    assert m1["CongestiveHeartFailure"] == 1 and m1["YYYYMM"] == "201909"
    assert rows["C1"]["CS_file_origin"] == "medicaid"
    assert rows["C2"]["CS_file_origin"] == "ZZZZZZ - ERROR"
    assert rows["E3"]["Member_DOB"] is None and rows["E3"]["Indv_ID"] is None
    assert e2["PSU_Score_Cutoff"] is None and str(e2["HCE_PredictiveScore"]) == "0.7000"
    assert rows["E2"]["MemberState"] is None or rows["E2"]["MemberState"] != "nan"


def test_keyless_collapse_parity(spark):
    src = SU.build_source(*_feeds(spark, EI, ACO, MR, CS), keyless="collapse")
    ids = [r["Member_ID"] for r in src.collect()]
    assert len([i for i in ids if i in ("E3", "E4")]) == 1


def test_merge_runs_and_surrogates(spark, tmp):
    cfg = SU.Config(ei="", ei_aco="", mr="", cs_mcr="", cs_mcd="", target=os.path.join(tmp, "t"))
    SU.run(spark, cfg, AS_OF, readers=_feeds(spark, EI, ACO, MR, CS))
    t = {r["Member_ID"]: r for r in VersionedTable(spark, cfg.target).read().collect()}
    pks = sorted(r["Primary_Key"] for r in t.values())
    assert pks == list(range(10_000_000_000, 10_000_000_000 + len(t)))
    ei2 = [dict(EI[1], MBR_FST_NM="Anne")] + EI[2:]
    m = SU.run(spark, cfg, "2019-10-26 04:00:00",
               readers=_feeds(spark, ei2 + [{"MBR_ID": "E9", "indv_id": "9", "pred_flag": "1"}],
                              ACO, MR, CS[:1]))
    t2 = {r["Member_ID"]: r for r in VersionedTable(spark, cfg.target).read().collect()}
    assert m["insert"] == 1 and t2["E9"]["Primary_Key"] == max(pks) + 1
    assert t2["E2"]["SuperUser_SubStatus"] == "Updated" and t2["E2"]["CountOfFiles"] == 2
    assert t2["C2"]["SuperUser_Status"] == "Inactive"
    assert t2["E2"]["Primary_Key"] == t["E2"]["Primary_Key"]
    flagged = {r["Member_ID"] for r in SU.persistent_super_users(spark, cfg).collect()}
    assert flagged == {k for k, r in t2.items() if r["Is_PSU"]} and "E2" in flagged
    assert spark.table("persistent_super_users").count() == len(flagged)


def test_fan_out_guard(spark, tmp):
    aco = ACO + [{"MBR_ID": "E2", "aco_flag": "0", "group_nm": "G2"}]   # Q4: two ACO rows
    cfg = SU.Config(ei="", ei_aco="", mr="", cs_mcr="", cs_mcd="", target=os.path.join(tmp, "t"))
    with pytest.raises(DataCheckError, match="E2"):
        SU.run(spark, cfg, AS_OF, readers=_feeds(spark, EI, aco, MR, CS))
    cfg.on_duplicate = "first"
    m = SU.run(spark, cfg, AS_OF, readers=_feeds(spark, EI, aco, MR, CS))
    assert m["insert"] == 6


def test_workbooks_1900_and_1904(spark, tmp):
    hdr = SU.CS_COLUMNS
    row = {"Member_Key": "K1", "Member_DOB": dt.date(1970, 5, 6), "pred_model": 0.5,
           "Member_Zip": 55401}
    for name, mode in (("mcr_a.xlsx", False), ("mcr_b.xlsx", True)):
        write_xlsx(os.path.join(tmp, name), [f" {h} " for h in hdr],
                   [[row.get(h) for h in hdr]], date1904=mode)
    got = read_workbooks(spark, tmp, hdr, AS_OF).collect()
    assert len(got) == 2
    assert {r["Member_DOB"] for r in got} == {"1970-05-06"}
    assert {r["Member_Zip"] for r in got} == {"55401"} and {r["pred_model"] for r in got} == {"0.5"}
    assert {r["FileName"] for r in got} == {"mcr_a.xlsx", "mcr_b.xlsx"}


def test_workbook_unknown_header(spark, tmp):
    write_xlsx(os.path.join(tmp, "bad.xlsx"), ["Member_Key", "nope"], [["K", "x"]])
    with pytest.raises(Exception, match="unknown columns"):
        read_workbooks(spark, tmp, SU.CS_COLUMNS).collect()


def _land_feeds(tmp, ei_lines):
    def text(folder, name, cols, lines):
        os.makedirs(os.path.join(tmp, folder), exist_ok=True)
        with open(os.path.join(tmp, folder, name), "w") as fh:
            fh.write("\t".join(cols) + "\n" + "".join(ln + "\n" for ln in lines))

    def book(folder, cols, rows):
        os.makedirs(os.path.join(tmp, folder), exist_ok=True)
        write_xlsx(os.path.join(tmp, folder, folder + ".xlsx"), cols, [[r.get(c) for c in cols] for r in rows])
    text("ei", "ei_2.txt", SU.EI_COLUMNS, ei_lines)
    text("aco", "aco.txt", SU.EI_ACO_COLUMNS, [])
    book("mr", SU.MR_COLUMNS, MR)
    book("mcr", SU.CS_COLUMNS, CS[:1])
    book("mcd", SU.CS_COLUMNS, CS[1:])
    at = lambda n: os.path.join(tmp, n)
    return SU.Config(ei=at("ei"), ei_aco=at("aco"), mr=at("mr"), cs_mcr=at("mcr"), cs_mcd=at("mcd"),
                     target=at("t"), stage=at("stage"), patterns={"ei": "ei_*.txt", "mr": "mr*.xlsx"})


def _ei_line(**v):
    v = {"Exchange_Ind": "N", **v}          # one character wide: a blank would become the text nan
    return "\t".join(str(v.get(c, "")) for c in SU.EI_COLUMNS)


def test_staged_counted_and_quarantined(spark, tmp):
    """Feeds are staged and counted, a surplus line is kept apart, an older delivery and
    older month of a workbook are not read, and a blank flag is no flag."""
    cfg = _land_feeds(tmp, [_ei_line(MBR_ID="E1", indv_id=1), _ei_line(MBR_ID="E2", indv_id=2, pred_flag=1),
                            _ei_line(MBR_ID="E9", indv_id=9) + "\tsurplus"])
    old = os.path.join(tmp, "ei", "ei_1.txt")
    with open(old, "w") as fh:
        fh.write("\t".join(SU.EI_COLUMNS) + "\n" + _ei_line(MBR_ID="E0", indv_id=0) + "\n")
    write_xlsx(os.path.join(tmp, "mr", "mr_old.xlsx"), SU.MR_COLUMNS, [["M0"] + [None] * (len(SU.MR_COLUMNS) - 1)])
    for f in (old, os.path.join(tmp, "mr", "mr_old.xlsx")):
        os.utime(f, (1_600_000_000, 1_600_000_000))
    m = SU.run(spark, cfg, AS_OF)
    assert m["staged"] == {"ei": 2, "ei_aco": 0, "mr": 2, "cs_mcr": 1, "cs_mcd": 1}
    assert m["quarantined"] == {"ei": 1, "ei_aco": 0}
    kept = spark.read.parquet(os.path.join(tmp, "stage", "quarantine", "ei")).collect()
    assert len(kept) == 1 and kept[0]["line"].endswith("surplus")
    t = {r["Member_ID"]: r for r in VersionedTable(spark, cfg.target).read().collect()}
    assert set(t) == {"E1", "E2", "M1", "C1", "C2"}
    assert t["E1"]["Is_PSU"] is None and t["E2"]["Is_PSU"] is True


def test_target_layout_enforced(spark, tmp):
    """K4: a text wider than its column and a NULL in a NOT NULL column stop the job."""
    cfg = SU.Config(ei="", ei_aco="", mr="", cs_mcr="", cs_mcd="", target=os.path.join(tmp, "t"))
    with pytest.raises(Exception, match="wider than 3 in column MarketSegment"):
        SU.run(spark, cfg, AS_OF, readers=_feeds(spark, [dict(EI[1], MKT_SEG_CD="LONG")], ACO, MR, CS))
    with pytest.raises(Exception, match="NOT NULL column Member_ID"):
        SU.run(spark, cfg, AS_OF, readers=_feeds(spark, [dict(EI[1], MBR_ID=None)], ACO, MR, CS))
    assert VersionedTable(spark, cfg.target).read() is None


def test_feeds_are_staged_together(spark, tmp, monkeypatch):
    """Each feed's stage waits until all five are at theirs; one after the other they would never meet."""
    import threading
    meet, write = threading.Barrier(len(SU.FEEDS)), SU.rebuild_stage

    def met(*args):
        meet.wait(60)
        return write(*args)
    monkeypatch.setattr(SU, "rebuild_stage", met)
    staged, m = SU.stage_feeds(spark, _land_feeds(tmp, [_ei_line(MBR_ID="E1", indv_id=1)]), AS_OF)
    assert {f: d.count() for f, d in staged.items()} == m["staged"] == {"ei": 1, "ei_aco": 0, "mr": 2, "cs_mcr": 1, "cs_mcd": 1}


def test_workbook_blocks_are_spread(spark, tmp, monkeypatch):
    """Narrow rows of many blocks are written by several tasks, one workbook a block."""
    from pyspark.sql import functions as F
    from pyspark import TaskContext
    from snapflow.plans import job_queries as J
    real = J._workbook_writer

    def noted(folder, columns, prefix):
        write = real(folder, columns, prefix)

        def run(g):
            open(os.path.join(folder, f"task_{TaskContext.get().partitionId()}"), "w").close()
            return write(g)
        return run
    monkeypatch.setattr(J, "_workbook_writer", noted)
    rows = spark.range(40).select(F.col("id").cast("string").alias("Member_Key"), "id").repartition(3)
    J.land_workbooks(rows, tmp, ["Member_Key"], F.col("id"), [F.col("id")], "b")
    found = os.listdir(tmp)
    assert sorted(f for f in found if f.endswith(".xlsx")) == sorted(f"b_{i}.xlsx" for i in range(40))
    assert sum(f.startswith("task_") for f in found) > 1
