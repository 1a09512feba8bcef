import os

import pytest
from pyspark.errors import AnalysisException

from casetrail.plans.seeds import build_seeds
from casetrail.streaming import land_exports

HEADER = ["管理NO", "報告者", "報告日", "内容", "コメント履歴"]
MAP = [{"name": "incident_id", "type": "map", "source": "管理NO"},
       {"name": "registered_by", "type": "map", "source": "報告者"},
       {"name": "registered_date", "type": "map", "source": "報告日"},
       {"name": "description", "type": "map", "source": "内容"},
       {"name": "comment_history", "type": "map", "source": "コメント履歴"},
       {"name": "category2", "type": "blank"}]


def write_export(path, rows):
    with open(path, "w", encoding="cp932", newline="") as fh:
        fh.write(",".join(f'"{h}"' for h in HEADER) + "\r\n")
        for r in rows:
            fh.write(",".join(f'"{v}"' for v in r) + "\r\n")


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_build_seeds_end_to_end(spark, tmp_out, fmt):
    src = os.path.join(tmp_out, "export.csv")
    write_export(src, [("SMPL-000001", "髙橋", "2024/1/5", "内容A",
                        "回答します\r\n詳細(回答:担当者 2024/01/06)\r\n完了(クローズ:担当者 2024/01/09)"),
                       ("SMPL-000002", "田中", "2024/1/7", "内容B", "")])
    cases, entries = build_seeds(spark, src, MAP, os.path.join(tmp_out, "cases"), os.path.join(tmp_out, "entries"), fmt)
    assert cases.count() == 2 and {r.category2 for r in cases.collect()} == {None}  # blank is NULL once landed
    with pytest.raises(AnalysisException):
        build_seeds(spark, src, MAP, os.path.join(tmp_out, "cases"), os.path.join(tmp_out, "entries"), fmt)
    got = sorted((r.incident_id, r.comment_seq, r.comment_div, r.comment) for r in entries.collect())
    assert got == [("SMPL-000001", 0, "新規登録", "内容A"), ("SMPL-000001", 1, "回答", "回答します詳細"),
                   ("SMPL-000001", 2, "クローズ", "完了"), ("SMPL-000002", 0, "新規登録", "内容B")]


def test_land_exports_once_and_again(spark, tmp_out):
    src, out = os.path.join(tmp_out, "in"), os.path.join(tmp_out, "out")
    os.makedirs(src)
    ck = os.path.join(tmp_out, "ckpt")
    write_export(os.path.join(src, "a.csv"), [("SMPL-000001", "a", "2024/1/1", "x", ""),
                                              ("SMPL-000002", "b", "2024/1/2", "y\r\nz", "")])
    land_exports(spark, src, out, HEADER, checkpoint=ck).awaitTermination()
    assert spark.read.parquet(out).count() == 2
    write_export(os.path.join(src, "b.csv"), [("SMPL-000003", "c", "2024/1/3", "w", "")])
    land_exports(spark, src, out, HEADER, checkpoint=ck).awaitTermination()
    rows = sorted(tuple(r) for r in spark.read.parquet(out).select("管理NO", "内容").collect())
    assert rows == [("SMPL-000001", "x"), ("SMPL-000002", "y\nz"), ("SMPL-000003", "w")]
