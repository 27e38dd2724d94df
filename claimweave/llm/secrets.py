"""Secret scan: fixed patterns, and character Markov models of random strings.

Two first-order Markov models over the characters of a token, one of random
strings and one of ordinary tokens, are trained from labelled samples: random
strings in common spellings, and every different token of the texts without a
fixed-pattern match, as it is and in capitals, so that a text in capitals is
ordinary too. A run of a token's characters whose log-likelihood ratio reaches
``LEAST_RATIO`` is a span of kind ``markov``, widened to the token's ends or the next
of ``= / _ -`` (a part between two of these of which the run has the smaller half is
left out), so text glued to a secret does not hide it, unless a span of the fixed
patterns holds it already. Tokens have no least length but the one that the
ratio needs.

All of it is SQL expressions. Each different token is scored once, however often
it occurs; the few that reach the ratio are joined back to the texts that hold
them, which alone are walked for positions. What is small enough by its bytes is
broadcast for that, else the join shuffles.

Defined cases: null and empty texts have no spans; matches that fail a
pattern's length still use up their text, as leftmost matches do; repeated rows
have equal results; without ordinary samples the smoothed models decide; an
empty table gives an empty result; texts are known by two 64-bit hashes. Only the
text (and for the samples the id) column is read; positions count code points,
ends are exclusive.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.sources.sinks import stage

#: (kind, pattern, group that has a least length, that length), in order.
#: Runs of one character class are maximal, so a least length of the whole match
#: can be part of the search: shorter runs fail and use up nothing else.
PATTERNS = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
)
_SEARCH = (PATTERNS[0][1], r"AKIA[A-Z0-9]{16,}", r"[0-9a-f]{24,}")
#: What any match of sufficient length contains; texts without it aren't searched.
_GATES = (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6}""",
          r"AKIA[A-Z0-9]{16}", r"[0-9a-f]{24}")
KINDS = (*[p[0] for p in PATTERNS], "markov")
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
#: Between these, text may be glued together.
SEPARATORS = "=/_-"
TOKEN = r"[A-Za-z0-9+/_=-]{%d,}"
#: Log ratio that a span needs, far above what mixed-case identifiers reach (about 15).
LEAST_RATIO = 25.0
#: Characters that smoothing adds to each state.
SMOOTHING = 10.0
_STATES = len(ALPHABET) + 1
#: Bytes of tokens, or of texts' hits, that are broadcast at most.
BROADCAST_BYTES = 8 << 20
#: Spans that are gathered together.
_CHUNK = 256
SPAN = "struct<start: bigint, kind: int, end: bigint>"
_NONE = f"array<{SPAN}>"
_CUTS = "array<struct<begin: int, end: int>>"


def _codes(token: Column) -> Column:
    """Characters as 1.. in the alphabet."""
    characters = F.filter(F.split(token, ""), lambda c: c != "")
    return F.transform(characters, lambda c: F.instr(F.lit(ALPHABET), c))


def _text(text_col: str) -> Column:
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def _gate(text: Column) -> Column:
    return text.rlike(_GATES[0]) | text.rlike(_GATES[1]) | text.rlike(_GATES[2])


def tokens_of(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(token, plain) of each different token, written once: how often it occurs in
    texts without a fixed-pattern match."""
    text = _text(text_col)
    # One row for each text first: what follows an explode is computed for each token.
    found = docs.select(F.regexp_extract_all(text, F.lit(TOKEN % 2), 0).alias("tokens"),
                        F.when(_gate(text), 0).otherwise(1).alias("plain"))
    found = found.select(F.explode("tokens").alias("token"), "plain")
    return stage(found.groupBy("token").agg(F.sum("plain").alias("plain")), "tokens")


def samples(docs: DataFrame, tokens: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Labelled samples (token, random, n), n times each: for each row random strings in
    common spellings, drawn from a hash of its id, and as ordinary ones the ``tokens``
    of texts in which no fixed pattern matches, as they are and in capitals."""
    tokens = tokens_of(docs, text_col) if tokens is None else tokens
    digest = F.sha2(F.concat(F.lit("sample:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 512)
    plain = F.base64(F.unhex(digest))
    short = F.regexp_replace(plain, "[+/=]", "")
    drawn = F.array(F.substring(digest, 1, 40), F.substring(plain, 1, 40), F.substring(short, 1, 32),
                    F.upper(F.substring(short, 41, 24)))
    return docs.select(F.explode(drawn).alias("token"), F.lit(True).alias("random"), F.lit(1).cast("long").alias("n")).union(
        tokens.filter("plain > 0").select(F.explode(F.array("token", F.upper("token"))), F.lit(False), "plain"))


@dataclass
class SecretModel:
    """Log ratio of each transition, by state before times states plus state after."""

    ratios: list[float]

    def ratio(self, token: Column) -> Column:
        """Log-likelihood ratio of a token: random against ordinary."""
        table = F.lit(np.array(self.ratios))  # one literal; an array() of literals is built for every character
        start = F.struct(F.lit(0).alias("state"), F.lit(0.0).alias("sum"))
        return F.aggregate(_codes(token), start, lambda acc, c: F.struct(
            c.alias("state"), (acc["sum"] + F.get(table, acc["state"] * _STATES + c)).alias("sum")))["sum"]

    def shortest(self, least: float) -> int:
        """Characters that a token needs at least for a ratio of ``least``."""
        most = max(self.ratios)
        return max(1, math.ceil(least / most)) if most > 0 else 1

    def best(self, token: Column) -> Column:
        """The largest ratio of any run of a token's characters, at least 0."""
        table = F.lit(np.array(self.ratios))
        zero = F.struct(F.lit(0).alias("state"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("peak"))
        return F.aggregate(_codes(token), zero, lambda acc, c: F.struct(
            c.alias("state"), F.greatest(F.lit(0.0), acc["sum"] + F.get(table, acc["state"] * _STATES + c)).alias("sum"),
            F.greatest(acc["peak"], acc["sum"]).alias("peak")),
            lambda acc: F.greatest(acc["peak"], acc["sum"]))

    def runs(self, token: Column, least: float) -> Column:
        """(begin, end) of the runs of a token that reach ``least``, each brought to the
        separators around it. A run ends where its ratio falls to 0, or by ``least``."""
        codes, table = _codes(token), F.lit(np.array(self.ratios))
        last = F.concat(F.array(F.lit(0)), F.slice(codes, 1, F.size(codes) - 1))
        ratios = F.zip_with(last, codes, lambda a, b: F.get(table, a * _STATES + b))
        zero = F.struct(F.lit(0).alias("at"), F.lit(0.0).alias("sum"), F.lit(0).alias("begin"), F.lit(0.0).alias("peak"),
                        F.lit(0).alias("end"), F.array().cast(_CUTS).alias("out"))
        found = lambda acc: F.when(acc["peak"] >= least, F.concat(acc["out"], F.array(
            F.struct(acc["begin"].alias("begin"), acc["end"].alias("end"))))).otherwise(acc["out"])

        def add(acc: Column, ratio: Column) -> Column:
            now, next_at = acc["sum"] + ratio, acc["at"] + 1
            over = (now <= 0) | (now <= acc["peak"] - least)
            up = ~over & (now > acc["peak"])
            return F.struct(
                next_at.alias("at"), F.when(over, 0.0).otherwise(now).alias("sum"),
                F.when(over, next_at).otherwise(acc["begin"]).alias("begin"),
                F.when(over, 0.0).when(up, now).otherwise(acc["peak"]).alias("peak"),
                F.when(over | up, next_at).otherwise(acc["end"]).alias("end"),
                F.when(over, found(acc)).otherwise(acc["out"]).alias("out"))

        part, apart = "[^=/_-]*", "[=/_-]*"
        size = lambda text, pattern: F.length(F.regexp_extract(text, pattern, 0))
        inside = lambda run: F.substr(token, run["begin"] + 1, run["end"] - run["begin"])
        before = lambda run: size(F.substr(token, F.lit(1), run["begin"]), f"{part}$")
        after = lambda run: size(F.substr(token, run["end"] + 1), f"^{part}")
        span = lambda begin, end: F.struct(begin.alias("begin"), end.alias("end"))

        def trimmed(run: Column) -> Column:
            return span(run["begin"] + size(inside(run), f"^{apart}"), run["end"] - size(inside(run), f"{apart}$"))

        def unglued(run: Column) -> Column:
            """Without parts at the edges of which the run has the smaller half."""
            head, tail, n = size(inside(run), f"^{part}"), size(inside(run), f"{part}$"), run["end"] - run["begin"]
            return span(run["begin"] + F.when((head < before(run)) & (head < n), head).otherwise(0),
                        run["end"] - F.when((tail < after(run)) & (tail < n), tail).otherwise(0))

        def widened(run: Column) -> Column:
            begin, end = run["begin"] - before(run), run["end"] + after(run)
            # A slash, or padding behind, that nothing stands beyond is part of the string.
            return span(F.when(F.substr(token, F.lit(1), begin).rlike("^/*$"), 0).otherwise(begin),
                        F.when(F.substr(token, end + 1).rlike("^[/=]*$"), F.length(token)).otherwise(end))

        cuts = F.aggregate(ratios, zero, add, found)
        for step in (trimmed, unglued, trimmed, widened):
            cuts = F.transform(cuts, step)
        return F.array_distinct(cuts)


def train(samples: DataFrame, smoothing: float = SMOOTHING) -> SecretModel:
    """Both Markov models from (token, random) rows, each ``n`` times if they have such
    a column; the driver receives at most two counts for each pair of characters."""
    times = F.col("n") if "n" in samples.columns else F.lit(1).cast("long")
    codes = samples.select("random", times.alias("n"), _codes(F.col("token")).alias("codes"))
    pair = F.zip_with(F.concat(F.array(F.lit(0)), F.slice("codes", 1, F.size("codes") - 1)), F.col("codes"),
                      lambda a, b: a * _STATES + b)
    rows = codes.filter(F.size("codes") > 0).select("random", "n", F.explode(pair).alias("pair")).groupBy("random", "pair").agg(F.sum("n").alias("n"))
    counts = {(r["random"], r["pair"]): r["n"] for r in rows.collect()}

    def log_p(random: bool) -> list[float]:
        """A state's transitions, smoothed by how frequent characters are at all."""
        single = [sum(counts.get((random, s * _STATES + c), 0) for s in range(_STATES)) + (0.5 if c else 0.0)
                  for c in range(_STATES)]
        out = []
        for state in range(_STATES):
            n = [counts.get((random, state * _STATES + c), 0) + smoothing * single[c] / sum(single) for c in range(_STATES)]
            out += [math.log(x / sum(n)) if x else 0.0 for x in n]
        return out

    ratios = [a - b for a, b in zip(log_p(True), log_p(False), strict=True)]
    # What joins a secret to other text is no evidence for either model.
    apart = {ALPHABET.index(c) + 1 for c in SEPARATORS}
    return SecretModel([0.0 if {k // _STATES, k % _STATES} & apart else x for k, x in enumerate(ratios)])


def _spans(text: Column, pattern: str, kind: int, cut: Callable[[Column, Column | None], Column],
           group: int | None = None) -> Column:
    """Spans ``cut(match, group of it)`` of all leftmost matches. Matches and the text
    between them alternate, so lengths give the positions. Spans are gathered in chunks,
    so that no long list is copied for each match. Whatever a lambda names is computed
    for each element: arrays go in as its arguments."""
    match = F.regexp_extract_all(text, F.lit(pattern), 0)
    own = match if group is None else F.regexp_extract_all(text, F.lit(pattern), group)
    pairs = F.zip_with(match, own, lambda m, g: F.struct(m.alias("m"), g.alias("g")))
    # The text after the last match comes without a match.
    parts = F.zip_with(pairs, F.split(text, pattern, -1), lambda p, gap: F.struct(
        F.length(gap).cast("long").alias("gap"), F.coalesce(F.length(p["m"]), F.lit(0)).cast("long").alias("n"),
        F.when(p["m"].isNotNull(), cut(p["m"], p["g"])).otherwise(F.array().cast(_CUTS)).alias("cuts")))
    none = F.array().cast(_NONE)
    zero = F.struct(F.lit(0).cast("long").alias("at"), none.alias("now"), F.array().cast(f"array<{_NONE}>").alias("out"))

    def add(acc: Column, part: Column) -> Column:
        start = acc["at"] + part["gap"]
        spans = F.transform(part["cuts"], lambda c: F.struct(
            (start + c["begin"]).alias("start"), F.lit(kind).alias("kind"), (start + c["end"]).alias("end")))
        full, any_ = F.size(acc["now"]) >= _CHUNK, F.size(part["cuts"]) > 0
        return F.struct((start + part["n"]).alias("at"),
                        F.when(full, spans).when(any_, F.concat(acc["now"], spans)).otherwise(acc["now"]).alias("now"),
                        F.when(full, F.concat(acc["out"], F.array(acc["now"]))).otherwise(acc["out"]).alias("out"))

    return F.aggregate(parts, zero, add, lambda acc: F.flatten(F.concat(acc["out"], F.array(acc["now"]))))


def _whole(match: Column) -> Column:
    return F.array(F.struct(F.lit(0).alias("begin"), F.length(match).alias("end")))


def fixed_spans(text: Column) -> list[Column]:
    """For each fixed pattern the array of its spans."""
    none = F.array().cast(_CUTS)
    out = []
    for kind, ((_, _, group, least), pattern, gate) in enumerate(zip(PATTERNS, _SEARCH, _GATES, strict=True)):
        cut = lambda m, g, least=least: F.when(F.length(g) >= least, _whole(m)).otherwise(none)
        spans = _spans(text, pattern, kind, cut, group)
        out.append(F.when(text.rlike(gate), spans).otherwise(F.array().cast(_NONE)))
    return out


def hits(tokens: DataFrame, model: SecretModel, least_ratio: float = LEAST_RATIO) -> DataFrame:
    """(token, cuts) of the tokens with a run that reaches the ratio, written once."""
    own = tokens.filter((F.length("token") >= model.shortest(least_ratio)) & (model.best(F.col("token")) >= least_ratio))
    return stage(own.select("token", model.runs(F.col("token"), least_ratio).alias("cuts")), "hits")


def _joinable(df: DataFrame, size: Column) -> DataFrame:
    """``df``, to be broadcast if its bytes are few."""
    total = df.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    return F.broadcast(df) if total <= BROADCAST_BYTES else df


def scan(docs: DataFrame, model: SecretModel, text_col: str = "text", least_ratio: float = LEAST_RATIO,
         tokens: DataFrame | None = None) -> DataFrame:
    """All columns as struct ``row``, the spans of each fixed pattern as array ``fixed``
    of arrays, and ``markov``: the spans that only the models find. ``tokens`` may be
    given if :func:`tokens_of` was called before."""
    text = _text(text_col)
    found = hits(tokens_of(docs, text_col) if tokens is None else tokens, model, least_ratio)
    pattern = TOKEN % model.shortest(least_ratio)
    marks = [F.xxhash64("text").alias("text_a"), F.xxhash64(F.lit(1), "text").alias("text_b")]
    held = docs.select(text.alias("text")).select(*marks, F.array_distinct(
        F.regexp_extract_all("text", F.lit(pattern), 0)).alias("tokens"))
    held = held.select("text_a", "text_b", F.explode("tokens").alias("token")).join(_joinable(found, F.length("token") + 16 * F.size("cuts")), "token")
    by_text = stage(held.groupBy("text_a", "text_b").agg(F.map_from_entries(F.array_distinct(
        F.collect_list(F.struct("token", "cuts")))).alias("hits")), "texts_with_hits")
    by_text = _joinable(by_text, F.aggregate(F.map_entries("hits"), F.lit(0).cast("long"), lambda n, h: n + 32 + F.length(
        h["key"]) + 16 * F.size(h["value"])))
    rows = docs.select(F.struct("*").alias("row"), text.alias("text")).select("row", "text", *marks)
    rows = rows.withColumn("fixed", F.array(*fixed_spans(F.col("text")))).join(by_text, ["text_a", "text_b"], "left")
    none = F.array().cast(_CUTS)
    spans = _spans(F.col("text"), pattern, len(PATTERNS), lambda m, _: F.coalesce(F.element_at("hits", m), none))
    known = F.flatten("fixed")
    fresh = F.filter("markov", lambda s: ~F.exists(known, lambda k: (k["start"] <= s["start"]) & (k["end"] >= s["end"])))
    rows = rows.withColumn("markov", F.when(F.col("hits").isNotNull(), spans).otherwise(F.array().cast(_NONE)))
    return rows.select("row", "fixed", fresh.alias("markov"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind, comma-joined."""
    name = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(F.array_sort(spans), one), ",")
