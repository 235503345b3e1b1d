"""CSV and Parquet output."""

from pyspark.sql import Column, DataFrame, DataFrameWriter

from ledgerlift.sources.replace import write_beside


def _save(df: DataFrame, writer: DataFrameWriter, path: str, in_place: bool) -> None:
    if in_place:
        writer.mode("overwrite").save(path)
    else:
        write_beside(df.sparkSession, path, writer.mode("errorifexists").save)


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", in_place: bool = False
) -> None:
    """Write a table of any size, one file per task and nothing through the driver.

    A table that is there already is replaced once the new one is complete, so a write that fails
    leaves the old one as it was; it may even be read by ``df``. ``in_place`` writes straight to
    ``path``, for stores that copy when they rename. CSV gets a header, keeps blanks at the ends of values and doubles the quotes in them. It
    cannot tell an empty string from null; Parquet can, and is the format between layers.
    """
    writer = df.write
    if fmt == "csv":
        writer = writer.options(
            header=True,
            escape='"',
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        )
    _save(df, writer.format(fmt), path, in_place)


def write_report(
    df: DataFrame,
    path: str,
    *order: Column | str,
    one_file: bool = False,
    in_place: bool = False,
) -> None:
    """Write a report as CSV with a header, sorted. It replaces an old one as ``write_table`` does.

    The caller chooses the layout, and it stays as it is however large the report gets:
    ``one_file`` is for reports whose size does not grow with the data, such as the balance. Any
    other is sorted by ranges over as many files as it needs; in the order of their names they hold
    the order of the report. The report needs no order of its own; a sort before this one is
    wasted.
    """
    if one_file:
        # Sort last, since coalesce may join sorted partitions in any order.
        out = df.coalesce(1)
        out = out.sortWithinPartitions(*order) if order else out
    else:
        out = df.orderBy(*order) if order else df
    _save(df, out.write.format("csv").option("header", True), path, in_place)
