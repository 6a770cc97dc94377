"""Arrow batches as Python takes them."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows whose Python objects and results a worker holds at once.
ROWS = 256


def slices(batches, rows: int = ROWS):
    """Batches cut small: their Python objects and results stay few, on both sides of the pipe."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def with_text(docs: DataFrame, kept: list[str], text_col: str) -> tuple[DataFrame, int]:
    """The kept columns and where among them the text is, as a string; a text that is kept goes to Python once."""
    columns = [F.col(f"`{c}`") for c in kept]
    if text_col in kept and docs.schema[text_col].dataType.simpleString() == "string":
        return docs.select(*columns), kept.index(text_col)
    return docs.select(*columns, F.col(text_col).cast("string").alias("__text")), len(kept)
