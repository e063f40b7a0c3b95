"""What is published about an event's sources and models: source groups by saved searches, and counts of tokens."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.clean import col, count_of, first_present, is_missing

#: Groups of sources, and characters that an estimate takes for one token.
FALLBACK = "fallback_sources"
PER_TOKEN = 4.0
PROMPT_SCOPE = "saved_prompt_without_chat_template"
CONTEXT_SCOPE = "news_context_only_excludes_instructions_metadata_and_chat_template"


def source_group(source: Column | str, url: Column | str, searched: Column | str, found: Column | str) -> Column:
    """struct(group, source): the group that was searched under an article's source, by name, else by where its address was found.

    ``searched`` maps names to groups; ``found`` is an array of struct(name, url), what each search gave. A name fits if it is
    the source, or what stands before `` (`` in it, case apart; it must be the only one. Addresses decide if all their names
    are of one group. Otherwise the group is null. Null maps and arrays count as empty.
    """
    own = F.trim(F.coalesce(col(source), F.lit("")))
    low = F.lower(own)
    names = F.coalesce(F.map_entries(col(searched)), F.array().cast("array<struct<key:string,value:string>>"))
    fits = F.filter(names, lambda x: (low == F.lower(x["key"])) | F.startswith(low, F.concat(F.lower(x["key"]), F.lit(" ("))))
    hits = F.coalesce(F.transform(F.filter(col(found), lambda r: r["url"].eqNullSafe(col(url))), lambda r: r["name"]), F.array().cast("array<string>"))
    seen = F.array_sort(F.filter(names, lambda x: F.array_contains(hits, x["key"])))
    pair = lambda x: F.struct(x["value"].alias("group"), x["key"].alias("source"))
    fallback = F.struct(F.lit(FALLBACK).alias("group"), F.lit("DuckDuckGo").alias("source"))
    one_group = F.size(F.array_distinct(F.transform(seen, lambda x: x["value"]))) == 1
    nothing = F.struct(F.lit(None).cast("string").alias("group"), own.alias("source"))
    return F.when(F.startswith(low, F.lit("duckduckgo")), fallback).when(F.size(fits) == 1, pair(F.get(fits, F.lit(0)))).when(one_group, pair(F.get(seen, F.lit(0)))).otherwise(nothing)


def token_usage(
    status: Column | str, recorded: Mapping[str, Column | str], method: Column | str, prompt: Column | str, response: Column | str, context: Column | str,
    counted: Mapping[str, Column | str] | None = None,
) -> Column:
    """Counts of a model call's tokens and where each comes from.

    ``recorded`` has ``input``, ``output`` and ``total``; ``counted`` has ``input`` and ``output``, where the saved texts were
    counted anew (null where no tokenizer was at hand). Calls that were skipped took none. Of calls that were made, a count is
    the recorded one, else the new one of its text, and a missing total is their sum; what still lacks one gets an estimate by
    characters, of the prompt, or of the news (``context``) if no prompt was kept. Other states have what was recorded.
    """
    state = F.coalesce(col(status), F.lit(""))
    skipped, called = (state == "dry_run") | F.startswith(state, F.lit("skipped_")), state == "called"
    none = F.lit(None).cast("long")
    kept = {"input": F.when(~is_missing(prompt), F.trim(col(prompt))), "output": F.when(~is_missing(response), col(response))}
    words = {"input": "retokenized_saved_prompt", "output": "retokenized_saved_response"}
    count, how = {}, {}
    for part in ("input", "output"):
        old = count_of(recorded[part])
        new = F.when(called & kept[part].isNotNull(), count_of((counted or {})[part])) if part in (counted or {}) else none
        count[part] = F.when(skipped, 0).otherwise(F.coalesce(old, new))
        how[part] = F.when(skipped, "not_called").when(old.isNotNull(), F.coalesce(first_present(method), F.lit("recorded"))).when(new.isNotNull(), words[part])
    old = count_of(recorded["total"])
    both = F.when(called, count["input"] + count["output"])
    count["total"] = F.when(skipped, 0).otherwise(F.coalesce(old, both))
    how["total"] = F.when(skipped, "not_called").when(old.isNotNull(), F.coalesce(first_present(method), F.lit("recorded"))).when(both.isNotNull(), "sum_of_available_counts")
    length = {"input": F.coalesce(F.length(kept["input"]).cast("long"), count_of(context)), "output": F.length(kept["output"]).cast("long")}
    guess = {part: F.when(called & count[part].isNull(), F.ceil(length[part] / PER_TOKEN).cast("long")) for part in length}
    scope = F.when(guess["input"].isNotNull(), F.when(kept["input"].isNotNull(), PROMPT_SCOPE).otherwise(CONTEXT_SCOPE))
    return F.struct(
        *[c.alias(f"{part}_tokens") for part, c in count.items()], *[c.alias(f"{part}_method") for part, c in how.items()],
        guess["input"].alias("estimated_input"), scope.alias("estimated_from"), guess["output"].alias("estimated_output"))
