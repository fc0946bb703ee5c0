"""Question and answer pairs: quality rules, decontamination, resuming, training messages, prompts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskit.functions import text as T
from corpuskit.sources.shared import materialise

#: Phrases that point to the passage instead of its content (fixed values), between word borders.
META = r"(?i)(^|[^\p{L}\p{N}_])(the (passage|text|article|paper|document|excerpt)|according to the (passage|text)|as (mentioned|stated) (above|in the))($|[^\p{L}\p{N}_])"


def quality(question: Column, answer: Column) -> dict[str, Column]:
    """Each rule as a column, and ``ok`` for all of them."""
    q, a = T.blank_if_null(question), T.blank_if_null(answer)
    rules = {
        "filled": (q != "") & (a != ""),
        "long_enough": (T.n_words(q) >= 5) & (T.n_words(a) >= 3),
        "no_meta": ~q.rlike(META) & ~a.rlike(META),
        "asks": T.strip(q).endswith("?"),
    }
    return rules | {"ok": rules["filled"] & rules["long_enough"] & rules["no_meta"] & rules["asks"]}


#: Hashes of grams that are broadcast at most; beyond, they are joined by a shuffle.
MOST_HASHES = 1 << 21


def gram_hits(
    rows: DataFrame, gold: DataFrame, id_col: str, text_col: str, gold_col: str = "text", n: int = 8, hashed: Callable[[Column], Column] = F.xxhash64, most: int = MOST_HASHES
) -> tuple[DataFrame, DataFrame]:
    """Word n-grams of rows, (id, gram, h), whose hash is that of a gram of a gold text, and the gold grams (gram, h).

    The hashes of gold grams are met in the stage that reads the rows, as long as there are at
    most ``most`` of them: only hits leave it, whose number doesn't depend on how
    many words the rows have. Different grams of one hash are among the hits.
    """
    wanted = materialise(gold.select(F.explode(T.grams(F.col(gold_col), n)).alias("gram")).distinct().withColumn("h", hashed(F.col("gram"))), "gold-grams")
    hashes = wanted.select("h").distinct()
    if wanted.count() <= most:
        hashes = F.broadcast(hashes)
    every = rows.select(id_col, F.explode(T.grams(F.col(text_col), n)).alias("gram")).withColumn("h", hashed(F.col("gram")))
    return every.join(hashes, "h", "left_semi").select(id_col, "gram", "h"), wanted


def contaminated_ids(rows: DataFrame, gold: DataFrame, id_col: str, text_col: str, gold_col: str = "text", n: int = 8, **options) -> DataFrame:
    """Ids of rows that share a word n-gram with a gold text; hits of hashes (see ``gram_hits``) are compared as texts."""
    hits, wanted = gram_hits(rows, gold, id_col, text_col, gold_col, n, **options)
    return hits.join(wanted.select("gram"), "gram", "left_semi").select(id_col).distinct()


def decontaminate(rows: DataFrame, gold: DataFrame, id_col: str, text_col: str, **options) -> DataFrame:
    return rows.join(contaminated_ids(rows, gold, id_col, text_col, **options), id_col, "left_anti")


def pending(chunks: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What an earlier run has not finished. A chunk that kept no pair is not among the done ones, and comes again."""
    return chunks.join(done.select(key).distinct(), key, "left_anti")


def pairs_wanted(n_words: Column) -> Column:
    return F.when(n_words < 200, 2).when(n_words < 350, 3).otherwise(4)


#: What stands around a passage in the prompt for pairs, and around documents in the prompt with context (fixed values).
PASSAGE = ("\n\nPassage (from ", '):\n"""\n', '\n"""\n\nProduce exactly ', " pairs.")
CONTEXT = ("--- Document [", "]: ", " ---\nContent:\n", "\n\n", "Context:\n", "\n\nQuestion: ", "\n\nAnswer:")


def qa_prompt(rules: str, title: Column, text: Column, n_words: Column) -> Column:
    before, after, ask, end = map(F.lit, PASSAGE)
    return F.concat(F.lit(rules), before, F.substring(title, 1, 90), after, text, ask, pairs_wanted(n_words).cast("string"), end)


def query_prompt(template: str, text: Column, n: int, most_chars: int = 1200) -> Column:
    """The caller's template with ``n`` for ``{n}`` and the first ``most_chars`` characters of a document for ``{doc}``."""
    before, after = template.replace("{n}", str(n)).split("{doc}")
    return F.concat(F.lit(before), F.substring(T.blank_if_null(text), 1, most_chars), F.lit(after))


def _turn(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def messages(system: str, question: Column, answer: Column) -> Column:
    return F.array(_turn("system", F.lit(system)), _turn("user", question), _turn("assistant", answer))


def chat_messages(system: str, history: Column, user: Column) -> Column:
    """A system message, what was said before (an array of (role, content), which may be null) and the user's message."""
    said = F.coalesce(history, F.array().cast("array<struct<role:string,content:string>>"))
    return F.concat(F.array(_turn("system", F.lit(system))), said, F.array(_turn("user", user)))


def parse_lines(reply: Column, most: int = 2) -> Column:
    """Queries in a model's reply: no bullets, numbers or headings, 3 to 30 words, without quotation marks around."""
    rows = F.transform(F.split(T.blank_if_null(reply), T.LINE_END), lambda x: T.strip(F.regexp_replace(T.strip(x), r"^[-*0-9. ]+", "")))
    kept = F.filter(rows, lambda x: (x != "") & ~F.lower(x).startswith("queries") & ~F.lower(x).startswith("document") & T.n_words(x).between(3, 30))
    return F.slice(F.transform(kept, lambda x: T.strip(F.regexp_replace(x, '^"+|"+$', ""))), 1, most)


def context_prompt(chunks: Column, question: Column, budget: int = 6000, share: bool = True) -> Column:
    """The user's message: numbered documents and the question; without documents the question alone.

    ``chunks``: an array of (title, text) by rank. The budget is shared by the
    documents or, without ``share``, cuts all of them together.
    """
    room = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(F.size(chunks), F.lit(1)))).cast("int")
    head, named, content, gap, begin, ask, end = map(F.lit, CONTEXT)

    def part(c: Column, i: Column) -> Column:
        return F.concat(head, (i + 1).cast("string"), named, c["title"], content, F.substr(c["text"], F.lit(1), room) if share else c["text"], gap)

    context = F.array_join(F.transform(chunks, part), "")
    context = context if share else F.substring(context, 1, budget)
    return F.when(F.size(chunks) > 0, F.concat(begin, context, ask, question, end)).otherwise(question)
