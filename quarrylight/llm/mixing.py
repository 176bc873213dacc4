"""Mixing sources to target weights by soft membership, with DataFrame and SQL functions alone.

A multinomial naive Bayes classifier over hashed words, counted on labelled documents, gives each document posteriors p over
domains. Document rates r >= low then solve a least-squares problem: the expected tokens of each domain, summed over documents
(r * tokens * p), shall equal the targets,

    1/2 |sum(r t p) - aim|^2 + RIDGE/2 sum(t (r - 1)^2),    t and aim as shares of all tokens,

where the tiny second term picks, of all that meet the targets alike, the rates nearest to 1. Its gradient in r, scaled by tokens, is
p.(sum(r t p) - aim) + RIDGE (r - 1), so the optimum has the form r = max(low, 1 - p.u) with one number u_k for each domain, and the
projected gradient steps run in u: each is one distributed sum over all documents of the residual and of the Gram matrix of the documents
that the bound doesn't hold (which scales the step, as in projected Newton methods), and halves while the dual objective doesn't fall.
That objective is convex and piecewise quadratic, so the steps end at the optimum; what doesn't get there raises.

With low = 1 the total is the smallest at which no document has to be lost; else the total stays as it is.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

#: Hash buckets of words; labelled documents that are counted at most (those of the smallest key hashes).
BUCKETS, SAMPLE = 8192, 4000
#: Log-odds from words are divided by the number of words to this power, as words of a text aren't independent.
TEMPER = 0.5
#: Weight of rates near 1 against residuals; accuracy of the optimum, in shares of all tokens; steps after which it is an error.
RIDGE, CLOSE, STEPS = 1e-6, 1e-10, 500


def text_hash(text: Column) -> Column:
    """With the key, the name of a row: rows of one key and text share a rate, rows of one key and different texts don't."""
    return F.xxhash64(F.coalesce(text, F.lit("")), F.octet_length(F.coalesce(text, F.lit(""))))


def _words(text: Column) -> Column:
    return F.explode(F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[ \\t\\n\\x0b\\f\\r]+"), lambda w: w != ""))


def _bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


def posteriors(df: DataFrame, key: str, text: str, labelled: DataFrame, domains: list[str], sample: int = SAMPLE) -> DataFrame:
    """(key, text_hash, tokens, p: array of posteriors in the order of domains), one row for each distinct key and text of df.

    labelled: (key, domain); domains not in the list, null keys and keys without a document take no part; a key that is labelled more than
    once counts with its least domain. Rows of one key and text count together; a null key is a key, a null text is an empty one. Texts
    without words have the domains' shares as posteriors. tokens: words and one end for each row.
    """
    docs = df.select(F.col(key).alias("__k"), text_hash(F.col(text)).alias("__h"), F.col(text).alias("__t"))
    few = labelled.toDF("__k", "__d").filter(F.col("__k").isNotNull() & F.col("__d").isin(domains)).groupBy("__k").agg(F.min("__d").alias("__d"))
    few = few.orderBy(F.xxhash64("__k"), "__k").limit(sample)
    counts = docs.join(F.broadcast(few), "__k").select("__d", _words(F.col("__t")).alias("w")).groupBy(_bucket(F.col("w")).alias("b")).agg(*(F.sum((F.col("__d") == d).cast("double")).alias(f"n{i}") for i, d in enumerate(domains)))
    counts = cut(counts, "mix-counts")  # at most BUCKETS rows
    sums = counts.agg(*(F.sum(f"n{i}") for i in range(len(domains)))).first()
    sums = [x or 0.0 for x in sums]
    shares = [(x + 1) / (sum(sums) + len(domains)) for x in sums]
    table = counts.select("b", *(F.log((F.col(f"n{i}") + 0.5) / F.lit(s + 0.5 * BUCKETS)).alias(f"l{i}") for i, s in enumerate(sums)))
    # a bucket that no labelled text has says as much as its smoothed count
    none = [F.log(F.lit(0.5 / (s + 0.5 * BUCKETS))) for s in sums]
    words = docs.select("__k", "__h", F.posexplode_outer(F.split(F.lower("__t"), "[ \\t\\n\\x0b\\f\\r]+")).alias("__at", "w")).withColumn("b", F.when(F.coalesce("w", F.lit("")) != "", _bucket(F.col("w"))))
    scored = words.join(F.broadcast(table), "b", "left")
    rows = F.sum((F.coalesce("__at", F.lit(0)) == 0).cast("long")).alias("__rows")
    per = scored.groupBy("__k", "__h").agg(rows, F.count("b").alias("__n"), *(F.sum(F.when(F.col("b").isNotNull(), F.coalesce(f"l{i}", none[i]))).alias(f"s{i}") for i in range(len(domains))))
    scale = F.pow(F.greatest(F.col("__n"), F.lit(1)).cast("double"), F.lit(TEMPER))
    # copies of one text say no more of its domain than the text does
    own = F.pow(F.col("__rows").cast("double"), F.lit(TEMPER - 1))
    logit = [F.coalesce(F.col(f"s{i}") / scale * own, F.lit(0.0)) + F.log(F.lit(shares[i])) for i in range(len(domains))]
    top = F.greatest(*logit) if len(logit) > 1 else logit[0]
    e = [F.exp(x - top) for x in logit]
    total = reduce(lambda a, b: a + b, e)
    return per.select(F.col("__k").alias(key), F.col("__h").alias("text_hash"), (F.col("__n") + F.col("__rows")).alias("tokens"), F.array(*(x / total for x in e)).alias("p"))


def rate_of(p: Column, u: list[float], low: float) -> Column:
    """The rate of a document with posteriors p."""
    z = reduce(lambda a, b: a + b, (p[i] * F.lit(float(x)) for i, x in enumerate(u)))
    return F.greatest(F.lit(float(low)), F.lit(1.0) - z)


def solve(post: DataFrame, targets: list[float], low: float = 0.0) -> tuple[list[float], list[float], list[float]]:
    """(u, the token totals aimed at, those reached) for post: tokens, p.

    targets: the domains' weights; they are scaled to sum to 1. A domain without any expected token can't gain one: its weight goes to
    the others. Without tokens u is 0.
    """
    k = len(targets)
    now = post.agg(F.sum("tokens").cast("double"), *(F.sum(F.col("tokens") * F.col("p")[i]) for i in range(k))).first()
    tokens, have = now[0] or 0.0, np.array([x or 0.0 for x in now[1:]])
    if not tokens:
        return [0.0] * k, [0.0] * k, [0.0] * k
    have /= tokens
    weight = np.where(have > 0, np.array(targets, float), 0.0)
    if not weight.sum():
        raise ValueError("no domain with a positive target has any expected token")
    weight /= weight.sum()
    aim = weight * (max(h / w for h, w in zip(have, weight) if w > 0) if low >= 1 else 1.0)
    share, p = F.col("tokens") / F.lit(tokens), F.col("p")

    def at(us: list[np.ndarray]) -> list[tuple[float, np.ndarray, np.ndarray]]:
        """Dual objective, reached shares and Gram matrix of the free documents at each u, in one job."""
        cols = []
        for u in us:
            z = reduce(lambda a, b: a + b, (p[i] * F.lit(float(x)) for i, x in enumerate(u)))
            free, r = z < F.lit(1.0 - low), rate_of(p, u, low)
            least = 1.0 - low
            cols.append(F.sum(share * F.when(free, z * z / 2 - z).otherwise(F.lit(-low) * z - F.lit(least * least / 2))))
            cols += [F.sum(share * r * p[i]) for i in range(k)]
            cols += [F.sum(F.when(free, share * p[i] * p[j]).otherwise(0.0)) for i in range(k) for j in range(i + 1)]
        row, out, n = post.agg(*(c.alias(f"c{i}") for i, c in enumerate(cols))).first(), [], 1 + k + k * (k + 1) // 2
        for m, u in enumerate(us):
            part = row[m * n : (m + 1) * n]
            gram = np.zeros((k, k))
            for x, (i, j) in zip(part[1 + k :], ((i, j) for i in range(k) for j in range(i + 1))):
                gram[i, j] = gram[j, i] = x
            out.append((part[0] + float(aim @ u) + RIDGE / 2 * float(u @ u), np.array(part[1 : 1 + k]), gram))
        return out

    u = np.zeros(k)
    (value, reached, gram), = at([u])
    for _ in range(STEPS):
        slope = reached - aim - RIDGE * u  # where this is 0 the objective is least
        if np.abs(slope).max() <= CLOSE * max(1.0, aim.sum()):
            return u.tolist(), (aim * tokens).tolist(), (reached * tokens).tolist()
        step = np.linalg.solve(gram + RIDGE * np.eye(k), slope)
        tried = [u + step * 4.0**-i for i in range(4)]
        for v, got in zip(tried, at(tried)):
            if got[0] <= value - 1e-4 * float(slope @ (v - u)) + 1e-15 * abs(value):
                u, (value, reached, gram) = v, got
                break
        else:  # a plain gradient step always helps: the objective's curvature is 1 + RIDGE at most
            u = u + slope / (1 + RIDGE)
            (value, reached, gram), = at([u])
    raise ArithmeticError(f"the rates don't converge: {math.log10(np.abs(slope).max()):.1f} off in log10")


def mix(df: DataFrame, key: str, text: str, labelled: DataFrame, targets: dict[str, float], low: float = 0.0, seed: int = 42) -> DataFrame:
    """(key, text_hash, tokens, p, rate, copies) for each distinct key and text: copies is the rate, rounded up or down by a uniform
    number from a hash of both, so that its expectation is the rate. Further columns take no part; an empty table gives no rows."""
    post = cut(posteriors(df, key, text, labelled, list(targets)), "mix-posteriors")
    u, _, _ = solve(post, list(targets.values()), low)
    dice = F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit("")), "text_hash", F.lit(seed)), 11) / F.lit(float(2**53))
    out = post.withColumn("rate", rate_of(F.col("p"), u, low))
    return out.select(key, "text_hash", "tokens", "p", "rate", F.floor(F.col("rate") + dice).cast("int").alias("copies"))
