import pytest

from furlong.sources import commits


def frame(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v int")


def values(df):
    return sorted(r["v"] for r in df.collect())


def test_a_commit_is_all_or_nothing(spark, folder):
    commits.commit(spark, folder, {"a": frame(spark, 1), "b": frame(spark, 2)})

    def broken():
        files = commits.write_files(frame(spark, 7), folder)
        assert files[0]["rows"] == 1
        raise RuntimeError("between two tables")

    with pytest.raises(RuntimeError):
        commits.commit(spark, folder, {"a": frame(spark, 5), "b": broken()})
    assert values(commits.read_version(spark, folder, "a")) == [1] and values(commits.read_version(spark, folder, "b")) == [2]
    second = commits.commit(spark, folder, {"a": frame(spark, 5, 6)}, note="more")
    assert second.number == 2 and second.tables["a"].rows == 2 and second.note == "more"
    assert values(commits.read_version(spark, folder, "a")) == [5, 6] and values(commits.read_version(spark, folder, "b")) == [2]
    assert values(commits.read_version(spark, folder, "a", 1)) == [1]
    with pytest.raises(FileNotFoundError):
        commits.read_version(spark, folder, "a", 9)


def test_a_manifest_that_was_not_finished_is_passed_over(spark, folder):
    commits.commit(spark, folder, {"a": frame(spark, 1)})
    for number, text in ((2, ""), (3, '{"tables": {}, "note"'), (4, '{"tables": {}, "note": "", "end": 3}')):
        with open(commits._manifest_path(folder, number), "w") as out:
            out.write(text)
    assert commits.latest(spark, folder).number == 1
    made = commits.commit(spark, folder, {"a": frame(spark, 2)})
    assert made.number == 5 and values(commits.read_version(spark, folder, "a")) == [2]


def test_of_two_writers_of_a_number_one_fails(spark, folder, monkeypatch):
    first = commits.commit(spark, folder, {"a": frame(spark, 1)})
    monkeypatch.setattr(commits, "numbers", lambda *_: [])
    monkeypatch.setattr(commits, "latest", lambda *_: None)
    with pytest.raises(commits.ConflictError):
        commits.commit(spark, folder, {"a": frame(spark, 2)})
    monkeypatch.undo()
    assert commits.latest(spark, folder) == first
    assert values(commits.read_version(spark, folder, "a")) == [1]


def test_empty_tables_and_parts(spark, folder):
    commits.commit(spark, folder, {"a": frame(spark)})
    assert commits.read_version(spark, folder, "a").columns == ["v"] and values(commits.read_version(spark, folder, "a")) == []
    rows = spark.createDataFrame([(i, i % 3) for i in range(9)], "v int, part int")
    files = commits.write_files(rows, folder, by="part")
    assert sorted({f["part"] for f in files}) == [0, 1, 2] and sum(f["rows"] for f in files) == 9
    made = commits.commit(spark, folder, {"a": commits.Table(frame(spark).schema.json(), files)})
    assert values(commits.read_table(spark, made, "a", {1})) == [1, 4, 7]
    assert commits.latest(spark, "/tmp/no-such-folder-at-all") is None
