"""Chat sessions: history, feedback, cached answers, suggestions, exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpuskit.functions import text as T


def recent_history(turns: DataFrame, skip_last: int = 1, n_turns: int = 3) -> DataFrame:
    """The messages before the last ``skip_last`` of each session, two for each of ``n_turns``."""
    back = F.row_number().over(W.partitionBy("conv_id").orderBy(F.col("turn").desc()))
    return turns.withColumn("back", back).where(F.col("back").between(skip_last + 1, skip_last + 2 * n_turns)).drop("back")


def with_question(turns: DataFrame) -> DataFrame:
    """Assistants' turns and the user's question right before each, else an empty one."""
    w = W.partitionBy("conv_id").orderBy("turn")
    asked = F.when(F.lag("role").over(w) == "user", F.lag("text").over(w))
    return turns.withColumn("question", F.coalesce(asked, F.lit(""))).where("role = 'assistant'")


def cache_key(question: Column) -> Column:
    return F.lower(T.strip(question))


def cached_answers(questions: DataFrame, cache: DataFrame, question_col: str = "text") -> DataFrame:
    """Questions with the answer kept for the same words, or null; ``cache`` has key and answer."""
    return questions.withColumn("key", cache_key(F.col(question_col))).join(cache.select("key", "answer"), "key", "left")


def session_title(question: Column) -> Column:
    t = T.strip(question)
    return F.concat(F.substring(t, 1, 40), F.when(F.length(t) > 40, "…").otherwise(""))


def followups(sources: Column, asked: Column, most: int = 3) -> Column:
    """Questions about titles of sources (an array by rank), each title once, without those asked already."""
    titles = F.filter(F.transform(sources, T.strip), lambda t: t != "")
    first = F.filter(titles, lambda t, i: F.array_position(F.transform(titles, F.lower), F.lower(t)) == i + 1)
    made = F.transform(first, lambda t: F.concat(F.lit('Tell me more about "'), F.substring(t, 1, 60), F.lit('"')))
    return F.slice(F.filter(made, lambda q: ~F.array_contains(asked, F.lower(q))), 1, most)


def confidence(scores: Column) -> Column:
    """``focused`` if the first score is at least 1.5 times the mean of the rest; needs two scores."""
    rest = F.slice(scores, F.lit(2), F.greatest(F.size(scores) - 1, F.lit(0)))
    mean = F.try_divide(F.aggregate(rest, F.lit(0.0), lambda a, x: a + x), F.size(rest))
    return F.when(F.size(scores) < 2, F.lit(None)).when((mean > 0) & (F.try_divide(F.get(scores, F.lit(0)), mean) >= 1.5), "focused").otherwise("close")


def export(turns: DataFrame, kind: str, title: str, stamp: str, status: str) -> DataFrame:
    """One document for each session, as ``md``, ``txt`` or ``json``; any other kind is ``md``."""
    ordered = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("m"))
    if kind == "json":
        said = F.transform("m", lambda m: F.struct(m["role"].alias("role"), m["text"].alias("content")))
        return ordered.select("conv_id", F.to_json(F.struct(F.lit(stamp).alias("exported_at"), F.lit(status).alias("model_status"), said.alias("messages"))).alias("document"))
    if kind == "txt":
        head = f"{title.upper()}\nExported: {stamp}\nModel status: {status}\n{'=' * 60}\n\n"
        body = F.transform("m", lambda m: F.concat(F.when(m["role"] == "user", "[USER]\n").otherwise("[ASSISTANT]\n"), m["text"], F.lit(f"\n\n{'-' * 60}\n")))
    else:
        head = f"# {title}\n\n_Exported: {stamp}_\n_Model status: {status}_\n\n"
        body = F.transform("m", lambda m: F.concat(F.when(m["role"] == "user", "### 🧑 User\n").otherwise("### 🤖 Assistant\n"), m["text"], F.lit("\n\n---\n")))
    return ordered.select("conv_id", F.concat(F.lit(head), F.array_join(body, "\n")).alias("document"))


def comparison(question: Column, direct: Column, grounded: Column, sources: Column, kind: str = "md", title: str = "Comparison Report", stamp: str = "") -> Column:
    """A report as ``md``, ``txt`` or ``json``, empty for any other kind; ``sources``: an array of (title, origin, score) by rank."""

    def numbered(line) -> Column:
        return F.array_join(F.transform(sources, lambda s, i: F.concat(*(x if isinstance(x, Column) else F.lit(x) for x in line(s, (i + 1).cast("string"), s["score"].cast("string"))))), "")

    if kind == "json":
        said = F.transform(sources, lambda s: F.struct(s["title"].alias("title"), s["origin"].alias("origin"), s["score"].alias("score")))
        answers = [question.alias("question"), direct.alias("direct_answer"), grounded.alias("rag_answer")]
        return F.to_json(F.struct(*answers, said.alias("sources"), F.lit(stamp).alias("exported_at")))
    if kind == "txt":
        listed = F.when(F.size(sources) > 0, numbered(lambda s, i, score: ("  ", i, ". ", s["title"], " - ", s["origin"], " (score: ", score, ")\n"))).otherwise("  No reference found.\n")
        head = F.concat(F.lit(f"{title.upper()}\nQuestion: "), question, F.lit(f"\n{'=' * 60}\n\n[DIRECT RESPONSE]\n"), direct)
        return F.concat(head, F.lit("\n\n[GROUNDED RESPONSE]\n"), grounded, F.lit("\n\n[REFERENCES]\n"), listed)
    if kind != "md":
        return F.lit("")
    listed = F.when(F.size(sources) > 0, numbered(lambda s, i, score: (i, ". [", s["title"], "](", s["origin"], ") - Score: ", score, "\n"))).otherwise("No reference found.")
    head = F.concat(F.lit(f'# {title}\n**Question Analyzed:** "'), question, F.lit('"\n\n---\n\n### Direct Response\n\n'), direct)
    return F.concat(head, F.lit("\n\n---\n\n### Grounded Response\n\n"), grounded, F.lit("\n\n---\n\n### References\n"), listed)
