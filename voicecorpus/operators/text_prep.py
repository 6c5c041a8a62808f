"""Books to sentence records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def split_books(books: DataFrame, book: str = "book_id", text: str = "text") -> DataFrame:
    """(book_id, order, sentence): each sentence of each book; order counts from 0."""
    return books.select(F.col(book).cast("string").alias("book_id"), F.posexplode(T.sentences(F.col(text))).alias("order", "sentence"))


def sentence_records(books: DataFrame, numbers: bool = True, **kw) -> DataFrame:
    """Sentence records; fragments without a token go after numbering, so gaps stay.  They are told
    by the sentence as it stands: a normal form has a token where it has one, and asked of the
    normal form, numbers would be spelled twice, for the filter and for the record."""
    d = split_books(books, **kw).where(F.col("sentence").rlike(T.TOKEN))
    normal = T.normalize(F.col("sentence"), numbers)
    d = d.select("book_id", T.sentence_id(F.col("book_id"), F.col("order")).alias("sent_id"), "order", T.clean_text(F.col("sentence")).alias("text"), normal.alias("normalized"))
    return d.withColumn("tokens", T.tokenize(F.col("normalized")))
