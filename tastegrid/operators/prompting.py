"""Prompt assembly: templates as data, prompts as one column expression."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastegrid.functions.text import blank

MAX_CONTEXT = 5


@dataclass(frozen=True)
class Part:
    """One document field in a template: shown as ``default`` where null, cut to ``width`` where given."""

    field: str
    default: str = "N/A"
    width: int | None = None


@dataclass(frozen=True)
class Template:
    """Prompt = head + (context_head + one block per document + context_tail) + before + query + after.

    ``block`` mixes literal text, ``Part`` fields and the marker ``NUMBER`` (1-based position).
    """

    name: str
    description: str
    head: str
    context_head: str
    block: tuple
    context_tail: str
    before: str
    after: str


NUMBER = object()
EXAMPLES = [
    ("Which space films came out after 2000?", "From the list:\n1. **First title (2009)** - a crew far from home\n2. **Second title (2014)** - a journey through time\n[Sources: catalogue]"),
    ("What has this director made?", "The catalogue names:\n1. **Third title (2010)** - a heist inside a dream\n2. **Fourth title (2012)** - a city at night\n[Sources: director index]"),
    ("I like action with jokes, what next?", "You may enjoy:\n1. **Fifth title (2012)** - agents and time travel\n2. **Sixth title (2012)** - a team that bickers\n[Sources: genre index]"),
    ("Which adventures are rated best?", "Best rated in the list:\n1. **Seventh title (2013)** - rating 7.6\n2. **Eighth title (2009)** - rating 7.4\n[Sources: ratings]"),
    ("Name films led by women.", "Good choices:\n1. **Ninth title (2010)** - a long way from the tower\n2. **Tenth title (2017)** - a hero between wars\n[Sources: character index]"),
]


def _examples(n: int) -> str:
    return "".join(f"\nExample {i}:\nQ: {q}\nA: {a}\n" for i, (q, a) in enumerate(EXAMPLES[:n], 1))


def _few_shot(n: int) -> Template:
    return Template(
        f"few_shot_k{n}",
        f"{n} worked examples before the question",
        f"Answer questions about the catalogue. Good answers look like this:\n{_examples(n)}\n",
        "\n\nDocuments:\n",
        ("\n[Doc ", NUMBER, "] ", Part("title", "Unknown"), " (", Part("year"), ")\nGenre: ", Part("genre"),
         " | Director: ", Part("director"), "\nPlot: ", Part("plot", "N/A", 200), "\n"),
        "",
        "\nNow answer in the same way.\n\nQ: ",
        "\nA:",
    )


TEMPLATES = [
    Template(
        "zero_shot",
        "the bare question with the documents",
        "Help the reader choose from the catalogue.\n",
        "\n\nRelevant items:\n",
        ("\n", NUMBER, ". ", Part("title", "Unknown"), "\n   Genre: ", Part("genre"), "\n   Year: ", Part("year"),
         "\n   Director: ", Part("director"), "\n   Plot: ", Part("plot", "N/A", 200), "...\n"),
        "",
        "\nQuestion: ",
        "\n\nAnswer briefly and name the items you used.",
    ),
    _few_shot(3),
    _few_shot(5),
    Template(
        "chain_of_thought",
        "reason in numbered steps before answering",
        "Answer the question by reasoning in steps.\n",
        "\n\nItems at hand:\n",
        ("\n[", NUMBER, "] Title: ", Part("title", "Unknown"), "\n    Year: ", Part("year"), "\n    Genre: ", Part("genre"),
         "\n    Director: ", Part("director"), "\n    Rating: ", Part("rating"), "\n    Plot: ", Part("plot", "N/A", 200), "\n"),
        "",
        "\nQuestion: ",
        "\n\nStep 1: what is asked?\nStep 2: which items fit?\nStep 3: rank them.\nStep 4: recommend.\n\nStep 1:",
    ),
    Template(
        "meta_prompt",
        "role, rules and output format before the question",
        "# ROLE\nYou are a careful film librarian.\n\n# RULES\n1. Use only the items given.\n2. Say so when they do not answer.\n"
        "3. At most 300 words, numbered list.\n4. Cite sources in [brackets] and end with HIGH, MEDIUM or LOW confidence.\n\n",
        "\n# ITEMS\n```\n",
        ("[Source ", NUMBER, "]: ", Part("title", "Unknown"), " (", Part("year"), ")\n  Genre: ", Part("genre"),
         "\n  Director: ", Part("director"), "\n  Rating: ", Part("rating"), "/10\n  Cast: ", Part("cast"),
         "\n  Plot: ", Part("plot", "N/A", 300), "\n\n"),
        "```\n",
        "\n# QUESTION\n",
        "\n\n# ANSWER\n",
    ),
]


def _field(doc: Column, part: Part) -> Column:
    value = F.coalesce(doc[part.field].cast("string"), F.lit(part.default))
    return value if part.width is None else F.substring(value, 1, part.width)


def render(template: Template, query: Column, context: Column) -> Column:
    """Prompt text; ``context`` is an array of document structs, the first five are used."""

    def block(doc: Column, i: Column) -> Column:
        shown = [
            (i + 1).cast("string") if p is NUMBER else _field(doc, p) if isinstance(p, Part) else F.lit(p)
            for p in template.block
        ]
        return F.concat(*shown)

    blocks = F.array_join(F.transform(F.slice(context, 1, MAX_CONTEXT), block), "")
    listing = F.when(
        F.size(context) > 0, F.concat(F.lit(template.context_head), blocks, F.lit(template.context_tail))
    ).otherwise(F.lit(""))
    return F.concat(F.lit(template.head), listing, F.lit(template.before), query, F.lit(template.after))


Strategy = Callable[[Column, Column], Column]
_STRATEGIES: dict[str, Strategy] = {}


def register_strategy(name: str, strategy: Strategy) -> None:
    """Add a strategy: (query column, context column) -> prompt column."""
    _STRATEGIES[name] = strategy


for _t in TEMPLATES:
    register_strategy(_t.name, lambda q, c, _t=_t: render(_t, q, c))
ALL_STRATEGIES = [t.name for t in TEMPLATES]


def select_strategies(names: str | list[str] = "all") -> list[str]:
    """``all`` or a list of registered names; an unknown name is an error."""
    if names == "all":
        return list(ALL_STRATEGIES)
    unknown = [n for n in names if n not in _STRATEGIES]
    if unknown:
        raise ValueError(f"unknown strategies: {unknown}; known: {sorted(_STRATEGIES)}")
    return list(names)


def build_prompts(df: DataFrame, strategies: str | list[str] = "all", query: str = "query", context: str = "context") -> DataFrame:
    """One row per input row and strategy: adds ``strategy``, ``ordinal`` and ``prompt``."""
    prompts = F.array(
        *[
            F.struct(
                F.lit(name).alias("strategy"),
                F.lit(i).alias("ordinal"),
                _STRATEGIES[name](F.col(query), F.col(context)).alias("prompt"),
            )
            for i, name in enumerate(select_strategies(strategies), 1)
        ]
    )
    return df.select("*", F.explode(prompts).alias("_p")).select(
        *df.columns, "_p.strategy", "_p.ordinal", "_p.prompt"
    )


def as_shown(docs: DataFrame) -> DataFrame:
    """``docs`` with each field cut to the most that any of TEMPLATES shows of it; their prompts are the same.

    For documents that are copied into the context of many questions.
    """
    widths: dict[str, list[int | None]] = {}
    for part in (p for t in TEMPLATES for p in t.block if isinstance(p, Part)):
        widths.setdefault(part.field, []).append(part.width)
    return docs.withColumns({f: F.substring(f, 1, max(w)) for f, w in widths.items() if f in docs.columns and None not in w})


def blurb_prompt(doc: Column, tone: Column, limit: Column) -> Column:
    return F.concat(
        F.lit("Write a "), tone, F.lit(" blurb of at most "), limit.cast("string"), F.lit(" characters.\n\nTitle: "),
        blank(doc["title"]), F.lit("\nGenre: "), blank(doc["genre"]), F.lit("\nYear: "), blank(doc["year"]),
        F.lit("\nPlot: "), F.substring(blank(doc["plot"]), 1, 300), F.lit("\n\nOnly the blurb."),
    )


def first_n_reviews(reviews: DataFrame, key: str, order: str, text: str, n: int = 5) -> DataFrame:
    """The first n reviews per item joined with a dashed line; at most n rows per key are collected."""
    w = Window.partitionBy(key).orderBy(order)
    first = reviews.select(key, order, text).withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n)
    collected = F.array_sort(F.collect_list(F.struct("_rn", text)))
    return first.groupBy(key).agg(F.array_join(F.transform(collected, lambda s: s[text]), "\n---\n").alias("reviews"))


def review_prompt(reviews: Column) -> Column:
    return F.concat(
        F.lit("Summarise these reviews in 2-4 sentences and judge the overall sentiment.\n\nReviews:\n"), reviews,
        F.lit("\n\nReply as:\nSUMMARY: ...\nSENTIMENT: positive, negative, mixed or neutral"),
    )


def extraction_prompt(text: Column) -> Column:
    return F.concat(
        F.lit("Extract film data from the text as one JSON object; null where absent.\n\nText: "), text,
        F.lit("\n\nFields: title, year, director, genres, cast, runtime_minutes"),
    )


def rationale_prompt(doc: Column, liked: Column) -> Column:
    taste = F.when(F.coalesce(liked, F.lit("")) != "", F.concat(F.lit("User enjoys: "), liked)).otherwise(F.lit(""))
    return F.concat(
        F.lit("One sentence, at most 100 characters: why this item?\n\nItem: "), blank(doc["title"]), F.lit(" ("),
        blank(doc["year"]), F.lit(")\nGenre: "), blank(doc["genre"]), F.lit("\nDirector: "), blank(doc["director"]),
        F.lit("\n"), taste,
    )
