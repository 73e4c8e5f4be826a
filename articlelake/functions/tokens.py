"""Token counting and hard splitting of oversized sentences.

A tokenizer turns an array of sentences into an array of `{text, tokens}` units, none of
them longer than the cap. Words are counted in the JVM. Callers with a vocabulary of their
own bring an object with the same method.
"""

from typing import Protocol

from pyspark.sql import Column
from pyspark.sql import functions as F

from articlelake.functions.binding import let

UNIT = "struct<text:string,tokens:int>"


class Tokenizer(Protocol):
    def units(self, sentences: Column, max_tokens: int) -> Column:
        """`UNIT`s of a column of sentences."""


class WordTokenizer:
    """One token per space-separated word; expects whitespace to be collapsed."""

    def count(self, text: Column) -> Column:
        return (F.length(text) - F.length(F.replace(text, F.lit(" "))) + 1).cast("int")

    def units(self, sentences: Column, max_tokens: int) -> Column:
        def parts(words: Column) -> Column:
            starts = F.sequence(F.lit(1), F.array_size(words), F.lit(max_tokens))
            return F.transform(
                starts,
                lambda i: let(
                    F.slice(words, i, max_tokens),
                    lambda w: F.struct(
                        F.array_join(w, " ").alias("text"), F.array_size(w).alias("tokens")
                    ),
                ),
            )

        def split(sentence: Column) -> Column:
            return let(
                self.count(sentence),
                lambda n: F.when(
                    n <= max_tokens,
                    F.array(F.struct(sentence.alias("text"), n.alias("tokens"))),
                ).otherwise(let(F.split(sentence, " ", -1), parts)),
            )

        return F.flatten(F.transform(sentences, split))


WORDS = WordTokenizer()
