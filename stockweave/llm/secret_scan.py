"""Secret scan: fixed patterns plus character Markov models, in DataFrame functions only.

First-order Markov models over the characters of a token are trained from labelled samples:
strings that the access and hex patterns mark, and digests of row numbers in four spellings,
are random, in hex digits (model 1) or in a larger alphabet (model 2); long tokens of the
corpus without any digit, and those whose parts are words, short numbers or words with a short
number behind, are ordinary (model 0); others have no label.  A token whose log-likelihood
ratio of either random model against the ordinary one reaches a threshold is a further span.

Neither scores nor threshold move with the size of the corpus: a pair that was not met has a
share of its row, not a count, and the threshold is one that few ordinary tokens kept from
training reach.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave.llm.store import stored

# The kinds in their order and their patterns.  Letters of the keywords are
# spelt in both cases, so that no engine folds other characters into them.
KINDS = ["assign", "access", "hex", "markov"]
KEYWORDS = ["password", "passwd", "secret", "token"]


def _either(word: str) -> str:
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() else c for c in word)


ASSIGN = (
    f"({'|'.join(map(_either, KEYWORDS))}|{_either('api')}_?{_either('key')})"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_VALUE = 8
# a run is maximal, so its least length can stand in the pattern itself
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SIZE = len(ALPHABET)
TOKEN = "[A-Za-z0-9+/_=-]{16,}"
LEARN_TOKEN = "[A-Za-z0-9+/_=-]{12,}"

_WORD = "([A-Za-z]{2,}[0-9]{0,4}|[A-Za-z]?[0-9]{1,4})"
IDENTIFIER = f"^{_WORD}([_/=+-]+{_WORD})*$"

SPAN = "struct<start:int,kind:int,end:int>"


def _spans(text: Column, pattern: str, kind: int, keep: str) -> Column:
    """Spans of a pattern's matches for which ``keep`` holds (an expression in ``w``, the
    match with its value in group ``v``), in code points.  Positions add up the lengths of
    the pieces between the matches and of the matches; texts without a match cost one scan."""
    walked = F.aggregate(
        F.arrays_zip(
            F.split(text, pattern, -1).alias("gap"),
            F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("w"),
            F.regexp_extract_all(text, F.lit(pattern), F.lit(2 if kind == 0 else 0)).alias("v"),
        ),
        F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("out")),
        lambda acc, m: F.struct(
            (acc["at"] + F.length(m["gap"]) + F.coalesce(F.length(m["w"]), F.lit(0))).alias("at"),
            F.when(
                m["w"].isNotNull() & _keep(m, keep),
                F.concat(
                    acc["out"],
                    F.array(
                        F.struct(
                            (acc["at"] + F.length(m["gap"])).alias("start"),
                            F.lit(kind).alias("kind"),
                            (acc["at"] + F.length(m["gap"]) + F.length(m["w"])).alias("end"),
                        )
                    ),
                ),
            )
            .otherwise(acc["out"])
            .alias("out"),
        ),
        lambda acc: acc["out"],
    )
    return F.when(text.rlike(pattern), walked).otherwise(F.array().cast(f"array<{SPAN}>"))


def _keep(match: Column, rule: str) -> Column:
    if rule == "value":
        return F.length(match["v"]) >= ASSIGN_VALUE
    if rule == "hits":
        return F.array_contains(F.col("hits"), match["w"])
    return F.lit(True)


def train(
    docs: DataFrame,
    text_col: str = "text",
    generated: int = 2000,
    smoothing: float = 0.5,
    unmet: float = 0.02,
    least: float = 12.0,
    rate: float = 0.0005,
) -> tuple[list[list[float]], float]:
    """Log-likelihood ratios of all character pairs, row by row of the alphabet, for each of
    the two random models, and the threshold for their sums.

    Counts cover every distinct token of 12 and more characters of every text but a tenth of
    the ordinary ones; of that tenth, a share of ``rate`` at most reaches the threshold, which
    is ``least`` at least.  The pairs that a row of counts lacks share ``unmet`` of it, however
    many tokens there are.  What comes to the driver is one count per label and pair, at most
    3 * 67 * 67 rows, and one number.  An empty table leaves the ordinary model uniform.
    """
    spark = docs.sparkSession
    text = F.col(text_col)
    tokens = docs.select(F.explode(F.regexp_extract_all(text, F.lit(LEARN_TOKEN), F.lit(0))).alias("token"))
    marked = F.when(F.col("token").rlike(f"^{HEX}$"), 1).when(F.col("token").rlike(f"^{ACCESS}$"), 2)
    ordinary = ~F.col("token").rlike("[0-9]") | F.col("token").rlike(IDENTIFIER)
    # -1: ordinary, but kept for the threshold
    marked = marked.when(ordinary, F.when(F.pmod(F.xxhash64("token"), F.lit(10)) == 0, -1).otherwise(0))
    tokens = stored(tokens.distinct().select("token", marked.alias("model")).where("model is not null"), "tokens")
    digest = F.sha2(F.col("id").cast("string"), 256)
    code = F.base64(F.unhex(digest))
    sample = lambda token, model: F.struct(token.alias("token"), F.lit(model).alias("model"))
    made = spark.range(generated).select(
        F.explode(
            F.array(
                sample(digest, 1),
                sample(F.regexp_replace(code, "[+/=]", ""), 2),
                sample(F.regexp_replace(code, "=", ""), 2),
                sample(F.upper(F.conv(F.substring(digest, 1, 15), 16, 36)), 2),
            )
        ).alias("made")
    )
    samples = tokens.where("model >= 0").unionByName(made.select("made.*"))
    pairs = samples.select(
        "model",
        F.explode(F.expr("transform(sequence(1, length(token) - 1), i -> substring(token, i, 2))")).alias("pair"),
    )
    counts = {(r["model"], r["pair"]): r["n"] for r in pairs.groupBy("model", "pair").agg(F.count("*").alias("n")).collect()}

    def logs(model: int) -> list[float]:
        out = []
        for a in ALPHABET:
            row = [counts.get((model, a + b), 0) for b in ALPHABET]
            row = [x + smoothing + unmet * sum(row) / SIZE for x in row]
            out += [math.log(x / sum(row)) for x in row]
        return out

    base = logs(0)
    ratios = [[r - o for r, o in zip(logs(model), base)] for model in (1, 2)]
    held = tokens.where("model = -1 and length(token) >= 16").select(F.expr(_best("token", ratios)).alias("score"))
    reached = held.agg(F.percentile_approx("score", 1 - rate, 10_000)).first()[0]
    return ratios, max(least, least if reached is None else reached + 1e-9)


def _best(token: str, ratios: list[list[float]]) -> str:
    """SQL for the better of a token's two ratios; each table is folded to one literal."""
    tables = [f"cast(split('{','.join(f'{x:.5f}' for x in table)}', ',') as array<double>)" for table in ratios]
    return f"greatest({', '.join(_score(token, table) for table in tables)})"


def _score(token: str, ratios: str) -> str:
    """SQL for a token's log-likelihood ratio; ``ratios`` is an array expression."""
    at = lambda i: f"(instr('{ALPHABET}', substring({token}, {i}, 1)) - 1)"
    return f"aggregate(sequence(2, length({token})), 0D, (s, i) -> s + {ratios}[{at('i - 1')} * {SIZE} + {at('i')}])"


def with_spans(docs: DataFrame, ratios: list[list[float]], threshold: float = 12.0, text_col: str = "text") -> DataFrame:
    """``docs`` with one more column ``secret_spans``: array of (start, kind, end), by start
    and kind; kind indexes KINDS, places are code points, ends exclusive.

    A null text counts as empty and has no span.  Markov spans are tokens of 16 and more
    characters with a letter and a digit that touch no span of the fixed patterns.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    score = _best("t", ratios)
    rich = "t rlike '[0-9]' and t rlike '[A-Za-z]'"
    base = F.concat(
        _spans(text, ASSIGN, 0, "value"), _spans(text, ACCESS, 1, ""), _spans(text, HEX, 2, "")
    )
    staged = docs.withColumns({"base": base, "tokens": F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))})
    hits = F.expr(f"filter(tokens, t -> {rich} and {score} >= {threshold})")
    staged = staged.withColumn("hits", hits).drop("tokens")
    found = F.when(F.size("hits") > 0, _spans(text, TOKEN, 3, "hits")).otherwise(F.array().cast(f"array<{SPAN}>"))
    staged = staged.withColumn("found", found)
    free = F.expr("filter(found, f -> not exists(base, b -> b.start < f.end and f.start < b.end))")
    return staged.withColumn("secret_spans", F.array_sort(F.concat("base", free))).drop("base", "hits", "found")


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_sha256, spans) of every whole text.

    Two passes over the texts (training, scan), one shuffle of distinct tokens.  Repeated
    rows give repeated results; other columns are not carried.
    """
    found = with_spans(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), *train(docs, text_col))
    spans = F.col("secret_spans")
    of = lambda k: F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("long")
    return found.select(
        F.col("id").alias(id_col),
        of(0).alias("n_assign"),
        of(1).alias("n_access"),
        of(2).alias("n_hex"),
        of(3).alias("n_markov"),
        F.sha2(_joined(F.filter(spans, lambda s: s["kind"] < 3)), 256).alias("base_sha256"),
        _joined(spans).alias("spans"),
    )


def redact(docs: DataFrame, mark: str = "[SECRET]", text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``docs`` with every span replaced by ``mark``; overlapping spans become one mark.

    The columns stay as they are, the length column follows the text.  Null texts stay null.
    """
    columns = docs.columns
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(text_col).alias("text"))
    found = with_spans(inner, *train(docs, text_col))
    pieces = F.expr(
        f"""aggregate(secret_spans, struct(0 as at, cast(array() as array<string>) as out),
          (a, s) -> case when s.start >= a.at
            then struct(s.end as at, concat(a.out, array(substring(text, a.at + 1, s.start - a.at), '{mark}')) as out)
            else struct(greatest(a.at, s.end) as at, a.out as out) end,
          a -> concat(array_join(a.out, ''), substring(text, a.at + 1)))"""
    )
    text = F.when(F.size("secret_spans") > 0, pieces).otherwise(F.col("text"))
    cleaned = found.select("row", text.alias("text"))
    own = {text_col: F.col("text"), length_col: F.when(F.col("text").isNull(), F.col(f"row.`{length_col}`")).otherwise(F.length("text").cast(docs.schema[length_col].dataType)) if length_col in columns else None}
    return cleaned.select(*[(own[c] if own.get(c) is not None else F.col(f"row.`{c}`")).alias(c) for c in columns])
