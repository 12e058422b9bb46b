"""Prompt tables and a hook for a completion function of the caller's."""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazette_lake.fixed import SUMMARY_INSTRUCTIONS, SUMMARY_QUESTION
from gazette_lake.functions.fields import as_json
from gazette_lake.schemas import COMPLETIONS, PUBLICATION_FIELDS


def prompt_table(publications: DataFrame, instructions: str = SUMMARY_INSTRUCTIONS,
                 question: str = SUMMARY_QUESTION) -> DataFrame:
    """(blob_key, messages): a system and a user message per publication."""
    record = F.struct(*PUBLICATION_FIELDS, "text", "is_digital")
    message = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return publications.select("blob_key", F.array(
        message("system", F.lit(instructions)),
        message("user", F.concat(F.lit(question), as_json(record))),
    ).alias("messages"))


def complete_with(prompts: DataFrame, complete: Callable[[list[dict]], str], tasks: int | None = None) -> DataFrame:
    """(blob_key, summary) from the caller's function, which gets one prompt's messages.

    ``tasks`` bounds how many calls run at once; rows are dealt out by key.
    """
    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            answers = [complete([dict(m) for m in messages]) for messages in frame["messages"]]
            yield pd.DataFrame({"blob_key": frame["blob_key"], "summary": answers})

    dealt = prompts.repartition(tasks, "blob_key") if tasks else prompts
    return dealt.mapInPandas(batches, COMPLETIONS)


def summaries(publications: DataFrame, completions: DataFrame) -> DataFrame:
    """Publications beside their summaries."""
    return publications.join(completions, "blob_key")
