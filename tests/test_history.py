from casetrail.operators.history import split_history
from casetrail.sources.schemas import HISTORY_INPUT


def rows(df):
    return [tuple(r) for r in df.orderBy("incident_id", "comment_seq").collect()]


def test_two_cases_two_plus_one_lines(spark):
    df = spark.createDataFrame([
        ("I001", "userA", "2023/10/1", "desc 1",
         "first answer(Answer:Team)User 2023/10/10)\nsecond(Close:UserB 2023/10/11)"),
        ("I002", "userC", "2023/10/2", "desc 2", "only one(Answer:UserD 2023/10/12)"),
    ], HISTORY_INPUT)
    got = rows(split_history(df))
    assert got == [
        ("I001", 0, "新規登録", "userA", "2023/10/1", "desc 1"),
        ("I001", 1, "Answer", "Team)User", "2023/10/10", "first answer"),
        ("I001", 2, "Close", "UserB", "2023/10/11", "second"),
        ("I002", 0, "新規登録", "userC", "2023/10/2", "desc 2"),
        ("I002", 1, "Answer", "UserD", "2023/10/12", "only one"),
    ]


def test_null_history_gives_registration_only(spark):
    df = spark.createDataFrame([("I003", "u", "2024/1/1", "d", None)], HISTORY_INPUT)
    assert rows(split_history(df)) == [("I003", 0, "新規登録", "u", "2024/1/1", "d")]


def test_carry_over_glue_and_dangling_tail(spark):
    h = "line one\r\nline two\x1cline three(Note:U 2024/02/03)\nleft over tail"
    df = spark.createDataFrame([("I004", "u", "2024/1/1", "d", h)], HISTORY_INPUT)
    got = rows(split_history(df))
    assert got[1:] == [("I004", 1, "Note", "U", "2024/02/03", "line oneline twoline three")]
    assert len(got) == 2  # the tail without a meta suffix is dropped


def test_empty_lines_and_duplicate_ids_are_per_row(spark):
    h = "a(T:U 2024/01/01)\n\nb(T:U 2024/01/02)\n"
    df = spark.createDataFrame([("I5", "u", "d", "x", h), ("I5", "v", "d", "y", "c(T:W 2024/01/03)")], HISTORY_INPUT)
    got = split_history(df).collect()
    seqs = sorted((r.comment_by, r.comment_seq, r.comment) for r in got)
    assert seqs == [("U", 1, "a"), ("U", 2, "b"), ("W", 1, "c"), ("u", 0, "x"), ("v", 0, "y")]


def test_line_without_closing_paren_position(spark):
    # the meta must sit at the very end of the line
    h = "mid (T:U 2024/01/01) not end\nend(T:U 2024/01/02)"
    df = spark.createDataFrame([("I6", "u", "d", "x", h)], HISTORY_INPUT)
    got = rows(split_history(df))
    assert got[1][5] == "mid (T:U 2024/01/01) not endend"


def test_every_line_separator_splits_as_in_python(spark):
    """All of str.splitlines' separators, and nothing else that looks like one."""
    seps = ["\n", "\r", "\r\n", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x85", " ", " "]
    others = ["\t", "\x1f", " ", "​", "\x00"]
    cells = [f"a{i}(T:U 2024/01/0{1 + i % 9}){s}b{i}(T:V 2024/02/0{1 + i % 9})" for i, s in enumerate(seps + others)]
    df = spark.createDataFrame([(f"I{i:02d}", "u", "d", "x", c) for i, c in enumerate(cells)], HISTORY_INPUT)
    got = {}
    for r in rows(split_history(df)):
        if r[1]:
            got.setdefault(r[0], []).append(r[5])
    want = {f"I{i:02d}": [f"a{i}", f"b{i}"] for i in range(len(seps))}
    want |= {f"I{i:02d}": [cells[i][:-len("(T:V 2024/02/01)")]] for i in range(len(seps), len(cells))}
    assert got == want
    assert all(len(c.splitlines()) == (2 if i < len(seps) else 1) for i, c in enumerate(cells))
