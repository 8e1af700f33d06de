import os

from stewardry.session import close, stage


def test_staged_rows_go_when_the_load_is_closed(spark):
    rows = stage(spark.range(5))
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    assert rows.count() == 5 and os.listdir(folder)
    close(spark)
    assert not os.path.exists(folder)
    assert stage(spark.range(3)).count() == 3
