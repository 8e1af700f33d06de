"""Column expressions over text: HTML, asset paths, dates, owner cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_tags(text: Column) -> Column:
    """Remove tags; a tag that runs over a line break stays."""
    return F.regexp_replace(text, r"<[^\n]*?>", "")


def wrap_div(text: Column) -> Column:
    return F.concat(F.lit("<div>"), text, F.lit("</div>"))


def table_path_parts(fqn: Column) -> dict[str, Column]:
    """Server, database, schema and table: the last four segments of a path.

    Segments a short path does not have are null.
    """
    segments = F.split(fqn, "/")
    return {
        name: F.try_element_at(segments, F.lit(place))
        for name, place in (
            ("serverEndpoint", -4),
            ("databaseName", -3),
            ("schemaName", -2),
            ("tableName", -1),
        )
    }


def storage_path_parts(fqn: Column) -> dict[str, Column]:
    """Endpoint, container, and the folder up to the first placeholder."""
    segments = F.split(fqn, "/")
    host = F.get(segments, F.lit(2))
    folder = F.array_join(F.slice(segments, F.lit(5), F.greatest(F.size(segments) - 4, F.lit(0))), "/")
    return {
        "serverEndpoint": F.concat(F.get(segments, F.lit(0)), F.lit("//"), host, F.lit("/")),
        "container": F.get(segments, F.lit(3)),
        "folderPath": F.substring_index(folder, "{", 1),
    }


def target_date_text(cell: Column) -> Column:
    """``MM-DD-YYYY`` as a midnight timestamp in text form; null for a bad date."""
    shaped = F.when(cell.rlike(r"^[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}$"), cell)
    day = F.try_to_date(shaped, "M-d-yyyy")
    return F.concat(day.cast("string"), F.lit("T00:00:00.000000Z"))


def without_spaces(cell: Column) -> Column:
    return F.replace(cell, F.lit(" "), F.lit(""))
