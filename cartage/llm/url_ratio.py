"""URL filter: rules first, then the log-likelihood ratio of two character models.

The models are variable-order Markov models (up to ``ORDER`` characters of context, Witten-Bell smoothed)
of the URLs that rules accept and of those that rules reject. Built from DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartage.session import materialize, scratch

# fixed values: (rule, verdict)
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))

ORDER = 4  # characters of context at most
ALPHABET = 256.0  # symbols the lowest order spreads its remaining mass over
CAPACITY = 200_000  # strings that are broadcast, the most frequent ones; the rest is joined
FOLDS = 5  # one fold of the labelled URLs calibrates, the others train
STEP = 0.05  # resolution of the threshold, in nats per character
_START, _END = "\u0002", "\u0003"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits host (or a parent domain of it) and the path's start, as (rule, verdict), else null."""
    found = F.lit(None)
    for rule, verdict in sorted(rules, key=lambda r: len(r[0])):
        domain, _, start = rule.partition("/")
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(f"/{start}")
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _grams(urls: DataFrame) -> DataFrame:
    """One row per character (and one for the end): the strings of length 1 to ORDER + 1 that end there.

    ``s`` starts with ORDER padding characters, so every position has a string of each length.
    """
    ends = F.explode(F.sequence(F.lit(ORDER + 1), F.length("s")))
    at = urls.withColumn("end", ends)
    return at.select(
        *[c for c in urls.columns if c != "s"],
        *[F.substring(F.col("s"), F.col("end") - n + 1, F.lit(n)).alias(f"g{n}") for n in range(1, ORDER + 2)],
    )


def _counted(labelled: DataFrame, uri: str) -> DataFrame:
    """``(gram, accepted, rejected)``: how often each string ends at a character of a training URL."""
    lengths = F.explode(F.array(*[F.col(f"g{n}") for n in range(1, ORDER + 2)]))
    grams = _grams(labelled.select("s", "good")).select(lengths.alias("gram"), "good")
    return materialize(
        grams.groupBy("gram").agg(
            F.sum(F.col("good").cast("long")).alias("accepted"), F.sum((~F.col("good")).cast("long")).alias("rejected")
        ),
        f"{uri}/grams",
    )


def _least_count(grams: DataFrame) -> int:
    """The least power of two that at most CAPACITY strings reach."""
    least = 1
    while grams.where(F.col("accepted") + F.col("rejected") >= least).count() > CAPACITY:
        least *= 2
    return least


def _model(grams: DataFrame, uri: str) -> tuple[DataFrame, float]:
    """``(string, ratio, backoff, n)``: log of the ratio of both models' smoothed probabilities of a string's last
    character, of the string as a context log of the ratio of what both models leave to shorter contexts, and how
    often the string occurs, in training URLs, as either. Besides, the back-off of the empty context, which is the
    ratio of a character that no training URL has.
    """
    grams = grams.withColumn("context", F.expr("left(gram, length(gram) - 1)"))
    contexts = grams.groupBy("context").agg(
        *[F.sum(c).alias(f"{c}_n") for c in ("accepted", "rejected")],
        *[F.sum((F.col(c) > 0).cast("long")).alias(f"{c}_t") for c in ("accepted", "rejected")],
    )
    contexts = materialize(contexts, f"{uri}/contexts")
    kept = materialize(grams.join(contexts, "context"), f"{uri}/kept")

    def smoothed(c: str, lower: Column) -> Column:
        n, t = F.col(f"{c}_n"), F.col(f"{c}_t")
        return F.when(n > 0, (F.col(c) + t * lower) / (n + t)).otherwise(lower)

    known = None
    for length in range(1, ORDER + 2):
        level = kept.where(F.length("gram") == length)
        if known is None:
            lower = {c: F.lit(1 / ALPHABET) for c in ("accepted", "rejected")}
        else:
            shorter = known.select(
                F.col("gram").alias("suffix"), F.col("p_accepted").alias("l_accepted"), F.col("p_rejected").alias("l_rejected")
            )
            level = level.withColumn("suffix", F.expr("substring(gram, 2)")).join(shorter, "suffix")
            lower = {c: F.col(f"l_{c}") for c in ("accepted", "rejected")}
        known = materialize(
            level.select("gram", (F.col("accepted") + F.col("rejected")).alias("n"), *[smoothed(c, lower[c]).alias(f"p_{c}") for c in ("accepted", "rejected")]), f"{uri}/order-{length}"
        )
        ratios = known.select("gram", "n", (F.log("p_accepted") - F.log("p_rejected")).alias("ratio"))
        model = ratios if length == 1 else model.unionByName(ratios)

    def left(c: str) -> Column:
        n, t = F.col(f"{c}_n"), F.col(f"{c}_t")
        return F.when(n > 0, F.log(t / (n + t))).otherwise(F.lit(0.0))

    backoffs = contexts.select(
        F.col("context").alias("string"), (left("accepted") - left("rejected")).alias("backoff"),
        (F.col("accepted_n") + F.col("rejected_n")).alias("context_n"),
    )
    both = model.withColumnRenamed("gram", "string").join(backoffs, "string", "full_outer")
    both = both.select("string", "ratio", "backoff", F.greatest("n", "context_n").alias("n"))
    both = materialize(both, f"{uri}/model")
    return both.where("string <> ''"), both.where("string = ''").first()["backoff"]


# what a character's score takes: ratios of the strings that end at it, back-offs of the contexts before it
_PARTS = [(f"r{n}", "ratio", f"right(g{ORDER + 1}, {n})") for n in range(1, ORDER + 2)]
_PARTS += [(f"b{n}", "backoff", f"left(right(g{ORDER + 1}, {n + 1}), {n})") for n in range(1, ORDER + 1)]


def _total(unseen: float) -> Column:
    """A character's log ratio: the longest known string decides, with what its longer contexts passed down.

    A character that no known string ends in has the ratio ``unseen`` before those.
    """
    total = F.coalesce("r1", F.lit(unseen))
    for length in range(2, ORDER + 2):
        total = F.coalesce(F.col(f"r{length}"), total + F.coalesce(F.col(f"b{length - 1}"), F.lit(0.0)))
    return total


def _scored(urls: DataFrame, model: DataFrame, unseen: float, least: int, uri: str) -> DataFrame:
    """``(uid, score)``: mean log ratio per character, end included, to twelve decimals.

    Strings that occur ``least`` times, 2 * CAPACITY at most, are broadcast once and all lookups share them. With
    rarer ones in the model, the characters whose longest string is not among the broadcast ones are told
    apart by that string alone; per such string, once, what the broadcast did not hold is joined by hash.
    """
    rows = _grams(urls)
    shared = F.broadcast(model.where(F.col("n") >= least).drop("n"))
    longest = f"g{ORDER + 1}"

    def looked_up(rows: DataFrame, key: Column, wanted: str, name: str) -> DataFrame:
        table = shared.alias("m")
        kept = [F.col(c) for c in rows.columns]
        return rows.join(table, key == F.col("m.string"), "left").select(*kept, F.col(f"m.{wanted}").alias(name))

    for name, wanted, string in _PARTS:
        rows = looked_up(rows, F.expr(string), wanted, name)
    if least <= 1:
        return rows.groupBy("uid").agg(F.round(F.avg(_total(unseen)), 12).alias("score"))

    names = [name for name, _, _ in _PARTS]
    own = F.when(F.col(f"r{ORDER + 1}").isNotNull(), F.lit(None)).otherwise(F.col(longest))
    # one row per URL for all that is settled, and one per URL and string that is not
    parts = rows.groupBy("uid", own.alias(longest)).agg(
        F.count(F.lit(1)).alias("times"), F.sum(_total(unseen)).alias("sum"), *[F.first(n).alias(n) for n in names]
    )
    parts = materialize(parts, f"{uri}/parts")
    open_ = parts.where(F.col(longest).isNotNull())
    strings = open_.groupBy(longest).agg(*[F.first(n).alias(n) for n in names])
    strings = materialize(strings, f"{uri}/strings")
    missing = F.filter(
        F.array(*[
            F.when(F.col(name).isNull(), F.struct(F.lit(name).alias("name"), F.expr(string).alias("string")))
            for name, _, string in _PARTS
        ]),
        lambda part: part.isNotNull(),
    )
    asked = strings.select(longest, F.inline(missing))
    rare = model.where(F.col("n") < least)
    found = asked.join(rare, "string").groupBy(longest).agg(
        *[F.max(F.when(F.col("name") == name, F.col(wanted))).alias(f"{name}_rare") for name, wanted, _ in _PARTS]
    )
    whole = strings.join(found, longest, "left").select(longest, *[F.coalesce(n, f"{n}_rare").alias(n) for n in names])
    totals = whole.select(longest, _total(unseen).alias("total"))
    late = open_.select("uid", longest, "times").join(totals, longest)
    sums = parts.where(F.col(longest).isNull()).select("uid", "times", "sum").unionByName(
        late.select("uid", "times", (F.col("times") * F.col("total")).alias("sum"))
    )
    return sums.groupBy("uid").agg(F.round(F.sum("sum") / F.sum("times"), 12).alias("score"))


def _threshold(judged: DataFrame) -> float:
    """The step at which accepting from there on has the best balanced accuracy; among equals the one nearest 0.

    The scores are counted by step first, so a few hundred rows are left.
    """
    step = F.floor(F.col("score") / STEP).cast("long")
    steps = judged.groupBy(step.alias("step")).agg(
        F.sum(F.col("good").cast("long")).alias("accepted"), F.sum((~F.col("good")).cast("long")).alias("rejected")
    )
    everything = Window.partitionBy()
    before = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    rates = steps.select(
        "step",
        (1 - F.try_divide(F.coalesce(F.sum("accepted").over(before), F.lit(0)), F.sum("accepted").over(everything))).alias("kept"),
        F.try_divide(F.coalesce(F.sum("rejected").over(before), F.lit(0)), F.sum("rejected").over(everything)).alias("caught"),
    )
    best = rates.where("kept is not null and caught is not null").orderBy(F.desc(F.round(F.col("kept") + F.col("caught"), 9)), F.abs("step"), "step").first()
    return best["step"] * STEP if best else 0.0


def judge_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """``(page_id, host, path, rule, verdict, score, threshold)`` per row of ``pages``.

    A rule decides the URLs it fits. The others are allowed when their score, the mean log ratio of the
    accepted and the rejected model per character of host and path, reaches the calibrated threshold. The
    models learn from the distinct URLs that rules decide, but for one fold that calibrates the threshold.
    A null URL, or one without ``://``, has empty host and path and is scored as an empty text. If
    the rules accept nothing or reject nothing, there is no model and the rest is allowed. Repeated rows are
    judged alike, null page_ids pass, other columns are ignored; an empty table gives an empty result.
    """
    uri = scratch(pages.sparkSession, "urls")
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn(
        "found", rule_of(F.col("host"), F.col("path"), rules)
    )
    padded = F.concat(F.lit(_START * ORDER), "host", "path", F.lit(_END))
    rows = materialize(
        parsed.select(
            F.monotonically_increasing_id().alias("uid"), "page_id", "host", "path", F.col("found.rule").alias("rule"),
            F.col("found.verdict").alias("by_rule"), padded.alias("s"),
        ),
        f"{uri}/rows",
    )
    calibrates = F.conv(F.substring(F.md5(F.col("s").cast("binary")), 1, 8), 16, 10).cast("long") % FOLDS == 0
    labelled = rows.where("by_rule is not null").select("s", (F.col("by_rule") == "allow").alias("good")).distinct()
    labelled = materialize(labelled.withColumn("calibrates", calibrates).withColumn("uid", F.monotonically_increasing_id()), f"{uri}/labelled")
    train = labelled.where(~F.col("calibrates"))
    # both kinds are needed, for training and for calibrating
    if train.select("good").distinct().count() < 2:
        decided = F.coalesce("by_rule", F.lit("allow"))
        return rows.select(
            "page_id", "host", "path", "rule", decided.alias("verdict"), F.lit(0.0).alias("score"), F.lit(0.0).alias("threshold")
        )
    grams = _counted(train, uri)
    model, unseen = _model(grams, uri)
    # what calibrates is scored along with the rest, under numbers below zero
    held = labelled.where("calibrates").select((-1 - F.col("uid")).alias("uid"), "s", "good")
    asked = rows.where("by_rule is null").select("uid", "s").unionByName(held.select("uid", "s"))
    scores = materialize(_scored(asked, model, unseen, _least_count(grams), uri), f"{uri}/scores")
    threshold = _threshold(scores.join(held.select("uid", "good"), "uid"))
    out = rows.join(scores, "uid", "left")
    by_model = F.when(F.col("score") >= threshold, "allow").otherwise("block")
    return out.select(
        "page_id", "host", "path", "rule", F.coalesce("by_rule", by_model).alias("verdict"), "score", F.lit(threshold).alias("threshold")
    )
