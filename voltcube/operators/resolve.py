"""Country-name resolution against a name -> ISO candidate table.

Steps, first success wins (a name is resolved by the lowest step that matches):

1. same name ignoring case;
2. the name is itself an ISO code of a candidate;
3. cleaned name equals a cleaned candidate name;
4. alias rule (a name containing "korea" -> the candidate containing "south korea");
5. closest cleaned candidate name, similarity >= cutoff;
6. closest lower-cased candidate name, similarity >= cutoff.

Within steps 1-4 several candidates can qualify: the first in candidate order
(``seq``) wins. In step 5 candidates sharing a cleaned name collapse to the
last one; in step 6 to the first one. Ties on the score go to the larger
matched string.

Steps 5-6 are a set similarity join on character 3-grams. Pairs are generated
by exact prefix filtering (rare grams first), so no name is compared with every
candidate, and no qualifying pair is lost. All of it is built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltcube import params as P
from voltcube.functions.scalar import clean_name
from voltcube.functions.similarity import similarity, trigrams
from voltcube.operators.joins import first_per_key

STEP_NAMES = {1: "exact", 2: "iso", 3: "cleaned", 4: "alias", 5: "fuzzy_cleaned", 6: "fuzzy_raw"}


def _prefixes(strings: DataFrame, col: str, freq: DataFrame, cutoff: float) -> DataFrame:
    """(group, gram, string, grams, position) of each string's prefix, rare grams first.

    A set of n grams shares at least ceil(cutoff * n) with any partner scoring
    >= cutoff, so two such sets meet in their first n - ceil(cutoff * n) + 1."""
    n = F.size("_grams")
    length = n - F.ceil(F.lit(cutoff) * n - F.lit(1e-9)).cast("int") + 1
    t = strings.select("_g", col, "_grams", length.alias("_plen"), F.explode("_grams").alias("gram"))
    t = t.join(freq, ["_g", "gram"], "left").withColumn("_f", F.coalesce("_f", F.lit(0)))
    w = Window.partitionBy("_g", col).orderBy("_f", "gram")
    return t.withColumn("_pos", F.row_number().over(w)).where(F.col("_pos") <= F.col("_plen")).select("_g", "gram", col, "_grams", "_pos")


def candidate_pairs(queries: DataFrame, q: str, cands: DataFrame, c: str, cutoff: float = P.FUZZY_CUTOFF,
                    group: str | None = None) -> DataFrame:
    """Pairs (_g, _q, _c and their grams) that share a prefix gram and whose sizes and
    positions allow the cutoff. A superset of all pairs that reach it."""
    g = F.col(group) if group else F.lit(0)
    grams = trigrams(F.col("_s"))
    qs = queries.select(g.alias("_g"), F.col(q).alias("_s")).where(F.col("_s").isNotNull()).distinct().select("_g", F.col("_s").alias("_q"), grams.alias("_grams"))
    cs = cands.select(g.alias("_g"), F.col(c).alias("_s")).where(F.col("_s").isNotNull()).distinct().select("_g", F.col("_s").alias("_c"), grams.alias("_grams"))
    freq = cs.select("_g", F.explode("_grams").alias("gram")).groupBy("_g", "gram").agg(F.count(F.lit(1)).alias("_f"))
    qp = _prefixes(qs, "_q", freq, cutoff).withColumnsRenamed({"_grams": "_qg", "_pos": "_qp"})
    cp = _prefixes(cs, "_c", freq, cutoff).withColumnsRenamed({"_grams": "_cg", "_pos": "_cp"})
    a, b = F.size("_qg"), F.size("_cg")
    # At this shared gram at most so many can be common: it and what is left of the shorter rest.
    most = F.lit(1) + F.least(a - F.col("_qp"), b - F.col("_cp"))
    first = qp.join(cp, ["_g", "gram"]).where((F.least(a, b) >= F.lit(cutoff) * F.greatest(a, b) - 1e-9))
    # The first shared gram of a pair has the smallest positions; only there the bound holds.
    first = first.groupBy("_g", "_q", "_c").agg(F.max(most).alias("_most"), F.first("_qg").alias("_qg"), F.first("_cg").alias("_cg"))
    need = F.lit(cutoff) / F.lit(1 + cutoff) * (F.size("_qg") + F.size("_cg"))
    return first.where(F.col("_most") >= need - 1e-9).drop("_most")


def similarity_join(queries: DataFrame, q: str, cands: DataFrame, c: str,
                    cutoff: float = P.FUZZY_CUTOFF, group: str | None = None) -> DataFrame:
    """All (query, candidate, score) with 3-gram similarity >= cutoff.

    Input frames hold strings in columns ``q`` and ``c``; with ``group`` only
    strings of the same group are compared (several matchings in one pass)."""
    pairs = candidate_pairs(queries, q, cands, c, cutoff, group)
    out = pairs.withColumn("score", similarity(F.col("_qg"), F.col("_cg"))).where(F.col("score") >= cutoff)
    cols = [F.col("_q").alias(q), F.col("_c").alias(c), "score"]
    return out.select(F.col("_g").alias(group), *cols) if group else out.select(*cols)


def _best(scored: DataFrame, keys, c: str) -> DataFrame:
    """Best candidate per query by (score, candidate string), both descending."""
    g = scored.groupBy(*keys).agg(F.max(F.struct("score", c)).alias("_b"))
    return g.select(*keys, F.col("_b.score").alias("score"), F.col(f"_b.{c}").alias(c))


def _keyed(df: DataFrame, col: str, keys) -> DataFrame:
    """One row per (string, step key): ``keys`` are (step, key column or NULL)."""
    items = F.array(*[F.struct(F.lit(step).alias("step"), k.alias("k")) for step, k in keys])
    return df.select("*", F.explode(items).alias("_x")).where(F.col("_x.k").isNotNull()) \
             .select("*", F.col("_x.step").alias("step"), F.col("_x.k").alias("k")).drop("_x")


def resolve_exact(names: DataFrame, cands: DataFrame, phrases=P.CLEAN_NAME_PHRASES,
                  aliases=P.NAME_ALIASES) -> DataFrame:
    """Steps 1-4 as one equi-join: every name and every candidate get one
    tagged key per step (lower-cased name, ISO code, cleaned name, alias rule)
    and the lowest matching step, then the first candidate, wins.

    ``names``: column ``name``; ``cands``: ``cand``, ``iso``, ``seq``.
    Returns name, iso_code, country, step for every name resolved."""
    n = names.select("name").where(F.col("name").isNotNull()).distinct()
    cd = cands.select("cand", "iso", "seq")
    name_keys = [(1, F.concat(F.lit("L|"), F.lower("name"))),
                 (2, F.concat(F.lit("I|"), F.upper("name"))),
                 (3, F.concat(F.lit("C|"), clean_name("name", phrases)))]
    cand_keys = [(1, F.concat(F.lit("L|"), F.lower("cand"))),
                 (2, F.concat(F.lit("I|"), F.col("iso"))),
                 (3, F.concat(F.lit("C|"), clean_name("cand", phrases)))]
    for i, (frm, to) in enumerate(aliases):
        name_keys.append((4, F.when(F.lower("name").contains(frm), F.lit(f"A{i}|"))))
        cand_keys.append((4, F.when(F.lower("cand").contains(to), F.lit(f"A{i}|"))))
    hits = _keyed(n, "name", name_keys).join(_keyed(cd, "cand", cand_keys).drop("step"), "k")
    best = first_per_key(hits, ["name"], F.struct("step", "seq"), ["cand", "iso", "step"])
    return best.select("name", F.col("iso").alias("iso_code"), F.col("cand").alias("country"), "step")


def resolve_fuzzy(names: DataFrame, cands: DataFrame, phrases=P.CLEAN_NAME_PHRASES,
                  cutoff: float = P.FUZZY_CUTOFF) -> DataFrame:
    """Steps 5-6 for the given names in one similarity join: group 5 compares
    cleaned names (candidates sharing a cleaned name collapse to the last one),
    group 6 lower-cased names (to the first one); a name takes step 5 if it
    matched there. Returns name, iso_code, country, step, score."""
    n = names.select("name").where(F.col("name").isNotNull()).distinct()
    cd = cands.select("cand", "iso", "seq")
    c5 = first_per_key(cd.withColumn("key", clean_name("cand", phrases)), ["key"], "seq", ["cand", "iso"], last=True)
    c6 = first_per_key(cd.withColumn("key", F.lower("cand")), ["key"], "seq", ["cand", "iso"])
    cand_keys = c5.withColumn("step", F.lit(5)).unionByName(c6.withColumn("step", F.lit(6)))
    query_keys = (n.select("name", F.lit(5).alias("step"), clean_name("name", phrases).alias("qkey"))
                   .unionByName(n.select("name", F.lit(6).alias("step"), F.lower("name").alias("qkey"))))
    scored = similarity_join(query_keys, "qkey", cand_keys, "key", cutoff, group="step")
    best = _best(scored, ["step", "qkey"], "key")
    hits = (query_keys.join(best, ["step", "qkey"]).join(cand_keys, ["step", "key"])
                      .select("name", "step", "score", "cand", "iso"))
    first = first_per_key(hits, ["name"], "step", ["cand", "iso", "step", "score"])
    return first.select("name", F.col("iso").alias("iso_code"), F.col("cand").alias("country"), "step", "score")


def resolve_names(names: DataFrame, cands: DataFrame, phrases=P.CLEAN_NAME_PHRASES,
                  aliases=P.NAME_ALIASES, cutoff: float = P.FUZZY_CUTOFF) -> DataFrame:
    """All steps. Returns name, iso_code, country, step for resolved names;
    unresolved names are absent (the caller keeps or drops them)."""
    n = names.select("name").where(F.col("name").isNotNull()).distinct()
    exact = resolve_exact(n, cands, phrases, aliases)
    # Exact steps (1-4) come before fuzzy ones (5-6), so only the names no
    # exact step resolves are scored in the similarity join.
    rest = n.join(exact.select("name"), "name", "left_anti")
    fuzzy = resolve_fuzzy(rest, cands, phrases, cutoff).drop("score")
    return exact.unionByName(fuzzy)
