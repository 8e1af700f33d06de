import os

from stewardry.llm.staging import hidden, release, staged


def test_staged_tables_are_read_from_their_files_and_released(spark):
    rows = staged(spark.range(5), "test")
    folder = os.path.dirname(rows.inputFiles()[0].removeprefix("file:").replace("///", "/"))
    assert rows.count() == 5 and os.path.isdir(folder)
    release(spark)
    assert not os.path.exists(folder)


def test_hidden_names_do_not_clash(spark):
    rows, names = hidden(spark.createDataFrame([(1, 2)], ["taken", "_given0"]))
    assert list(names) == ["taken", "_given0"] and rows.columns == list(names.values())
