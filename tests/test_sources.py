import pytest
from pyspark.errors import AnalysisException
import os

from casetrail.sources.files import read_export, read_seed
from casetrail.sources.schemas import ENTRY_TYPES


def test_read_seed_bom_empty_and_bool_digits(spark, tmp_out):
    p = os.path.join(tmp_out, "types.csv")
    with open(p, "w", encoding="utf-8-sig", newline="") as fh:
        fh.write('"comment_div","ball_on","is_closer","is_approver","is_patch_planned","is_response"\r\n')
        fh.write('"検収","dev",0,1,0,0\r\n')
        fh.write('"保留","",0,0,1,0\r\n')
    rows = [tuple(r) for r in read_seed(spark, p, ENTRY_TYPES).collect()]
    assert rows == [("検収", "dev", False, True, False, False), ("保留", None, False, False, True, False)]


def test_read_export_cp932_two_batches_one_header(spark, tmp_out):
    paths = []
    batches = [[("SMPL-000001", "髙橋①\r\n二行目"), ("SMPL-000002", "b")], [("SMPL-000003", "c")]]
    for i, rows in enumerate(batches):
        p = os.path.join(tmp_out, f"export{i}.csv")
        with open(p, "w", encoding="cp932", newline="") as fh:
            fh.write('"管理NO","内容"\r\n')
            for a, b in rows:
                fh.write(f'"{a}","{b}"\r\n')
        paths.append(p)
    df = read_export(spark, paths)
    got = sorted(tuple(r) for r in df.collect())
    assert df.columns == ["管理NO", "内容"]
    assert got == [("SMPL-000001", "髙橋①\n二行目"), ("SMPL-000002", "b"), ("SMPL-000003", "c")]


def test_materialize_view_and_table(spark):
    import uuid
    from casetrail.sources.files import materialize
    df = spark.range(5).withColumnRenamed("id", "k")
    v = materialize(df, "ct_test_view", "view")
    assert spark.table("ct_test_view").count() == 5 and v is df
    name = f"ct_test_{uuid.uuid4().hex[:8]}"
    t = materialize(df, name, "table")
    assert sorted(r.k for r in t.collect()) == list(range(5))
    with pytest.raises(AnalysisException):
        materialize(spark.range(3), name, "table")  # refused, and left as it is
    assert t.count() == 5
    assert spark.conf.get("spark.checkpoint.dir").rstrip("/") in t.inputFiles()[0]
