"""Sinks: split files, review sheets, metrics and the registry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The wording of the Markdown review sheet.
MARKDOWN_TITLE = "# Human Evaluation Samples\n"
MARKDOWN_RATING = "**Rating:** [ ] 1  [ ] 2  [ ] 3  [ ] 4  [ ] 5\n"
MARKDOWN_NOTES = "**Notes:**\n\n---\n"


def write_splits(df: DataFrame, path: str, columns: tuple[str, ...] = ("text",)) -> None:
    """JSON Lines under ``split=<name>``; a split without rows gets no folder. No shuffle."""
    df.select(*columns, "split").write.mode("overwrite").partitionBy("split").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Quoted CSV with a header that keeps blanks at the ends of a cell."""
    df.write.mode("overwrite").csv(
        path,
        header=True,
        quoteAll=True,
        quote='"',
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def review_csv_rows(samples: DataFrame) -> DataFrame:
    return samples.select(
        "sample_id", "prompt", "reference", "generated", F.lit("").alias("rating"), F.lit("").alias("notes")
    )


def write_review_csv(samples: DataFrame, path: str) -> None:
    rows = review_csv_rows(samples).orderBy("sample_id")
    write_csv(rows, path)


def write_review_json(samples: DataFrame, path: str) -> None:
    """JSON Lines with explicit nulls."""
    rows = samples.select(
        "sample_id",
        "prompt",
        "reference",
        "generated",
        "metadata",
        F.lit(None).cast("int").alias("rating"),
        F.lit("").alias("notes"),
    )
    rows.orderBy("sample_id").write.mode("overwrite").option("ignoreNullFields", False).json(path)


def review_markdown_blocks(samples: DataFrame) -> DataFrame:
    """``(sample_id, block)``: one text block per sample; the first carries the title."""

    def section(title: str, name: str):
        return F.concat(F.lit(f"**{title}:**\n```\n"), F.col(name), F.lit("\n```\n"))

    lines = F.array(
        F.when(F.col("sample_id") == 1, F.lit(MARKDOWN_TITLE)),
        F.format_string("## Sample %d\n", F.col("sample_id")),
        section("Prompt", "prompt"),
        F.when(F.col("reference") != "", section("Reference", "reference")),
        section("Generated", "generated"),
        F.lit(MARKDOWN_RATING),
        F.lit(MARKDOWN_NOTES),
    )
    return samples.select("sample_id", F.array_join(lines, "\n").alias("block"))


def write_review_markdown(samples: DataFrame, path: str) -> None:
    blocks = review_markdown_blocks(samples).orderBy("sample_id")
    blocks.select(F.col("block").alias("value")).write.mode("overwrite").text(path)


def write_metrics(results: DataFrame, path: str) -> None:
    """Result rows as JSON Lines."""
    results.write.mode("overwrite").json(path)


def append_registry(rows: DataFrame, path: str) -> None:
    """New registry rows go into new files; nothing existing is rewritten."""
    rows.write.mode("append").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(path)
