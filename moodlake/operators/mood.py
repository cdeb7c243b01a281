"""Two-tier mood classification as native column expressions.

Tier 1: ten rule scores plus a genre-family bonus; the universal mood is the
first maximum in mood order.  Tier 2: within the track's genre family, five
weighted sub-label scores; the sub-label is the first maximum.  Parameters are
folded into the expressions when the plan is built (weight sign and magnitude
are constants), so the job runs without any Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodlake.functions.expr import clip01, nan_to_null
from moodlake.functions import params as P

SUB_FEATURES = ["danceability", "energy", "valence", "acousticness", "instrumentalness",
                "tempo_norm", "loudness_norm", "speechiness", "liveness", "mode"]


# ---------------------------------------------------------------------------
# lookups (bounded, constant size -> broadcast is safe)
# ---------------------------------------------------------------------------
def genre_family_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(P.genre_family_pairs(), "genre string, genre_family string")


def mood_catalog(spark: SparkSession) -> DataFrame:
    """Ten universal moods with rank and description."""
    return spark.createDataFrame([(i, m, d) for i, (m, d) in enumerate(P.UNIVERSAL_MOODS)],
                                 "mood_rank int, mood string, description string")


def sub_label_catalog(spark: SparkSession) -> DataFrame:
    """Fifty sub-labels: family, ordinal, name, description."""
    return spark.createDataFrame(P.sub_label_rows(),
                                 "genre_family string, ordinal int, mood_label string, mood_description string")


def genre_family(df: DataFrame, genre_col: str = "track_genre", out: str = "genre_family") -> DataFrame:
    """Family of lower(genre) via a broadcast join to the 114-row map; unknown
    or null genres fall back to the default family."""
    if genre_col not in df.columns:
        return df.withColumn(out, F.lit(P.DEFAULT_FAMILY))
    spark = df.sparkSession
    fam = F.broadcast(genre_family_table(spark).withColumnRenamed("genre_family", "_fam"))
    j = df.join(fam, F.lower(df[genre_col]) == fam["genre"], "left")
    return j.withColumn(out, F.coalesce(F.col("_fam"), F.lit(P.DEFAULT_FAMILY))).drop("genre", "_fam")


# ---------------------------------------------------------------------------
# M1: feature normalisation
# ---------------------------------------------------------------------------
def normalize_features(df: DataFrame) -> DataFrame:
    """loudness_norm, tempo_norm (both clipped to [0,1]), numeric mode with
    default 0; missing values filled with the classifier defaults."""
    def raw(c: str) -> Column:  # an absent column behaves like an all-missing one
        return nan_to_null(F.col(c).cast("double")) if c in df.columns else F.lit(None).cast("double")

    loud = F.coalesce(raw("loudness"), F.lit(P.LOUDNESS_FILL))
    tempo = F.coalesce(raw("tempo"), F.lit(P.TEMPO_FILL))
    mode = F.coalesce(raw("mode"), F.lit(P.MODE_FILL))
    return df.withColumns({
        "loudness_norm": clip01((loud + F.lit(P.LOUDNESS_SHIFT)) / F.lit(P.LOUDNESS_SCALE)),
        "mode": mode,
        "tempo": tempo,
        "tempo_norm": clip01((tempo - F.lit(P.TEMPO_SHIFT)) / F.lit(P.TEMPO_SCALE)),
    })


# ---------------------------------------------------------------------------
# M4-M6: universal mood.  Scores are SQL text, parsed in one call each: built
# call by call over the bridge to the JVM, the same plan takes seconds.
# ---------------------------------------------------------------------------
def _present(name: str) -> str:
    """A feature as double, NaN as null."""
    x = f"cast(`{name}` as double)"
    return f"(case when not isnan({x}) then {x} end)"


def _number(x: float) -> str:
    return f"{float(x)!r}D"


def _text(x: str) -> str:
    return "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _cond(cols: set[str], cond) -> str:
    if cond[0] == "any":
        return "(" + " or ".join(_cond(cols, c) for c in cond[1]) + ")"
    feat, op, limit = cond
    x = _present(feat) if feat in cols else _number(P.ABSENT_DEFAULTS[feat])
    return f"({x} {op if op in '<>' else '='} {_number(limit)})"


def mood_score_text(cols: set[str], family_col: str = "genre_family") -> dict[str, str]:
    """Integer score per mood: first branch, else-if branch, else 0, plus the
    family bonus.  A missing (null/NaN) feature makes its conditions false."""
    out = {}
    for mood in P.MOOD_NAMES:
        branches = " ".join(f"when {' and '.join(_cond(cols, c) for c in conds)} then {points}"
                            for points, conds in P.MOOD_RULES[mood])
        bonus = " ".join(f"when {_text(fam)} then {b[mood]}" for fam, b in P.GENRE_BIAS.items() if mood in b)
        out[mood] = f"case {branches} else 0 end" + (f" + case `{family_col}` {bonus} else 0 end" if bonus else "")
    return out


def universal_mood(df: DataFrame, family_col: str = "genre_family", out: str = "mood",
                   keep_scores: bool = False) -> DataFrame:
    """The first mood, in catalog order, with the largest score."""
    scores = mood_score_text(set(df.columns), family_col)
    names = {m: f"score_{m.lower()}" for m in P.MOOD_NAMES}
    with_scores = df.withColumns({names[m]: F.expr(text) for m, text in scores.items()})
    best = f"greatest({', '.join(names.values())})"
    pick = " ".join(f"when {names[m]} = {best} then {_text(m)}" for m in P.MOOD_NAMES)
    res = with_scores.withColumn(out, F.expr(f"case {pick} end"))
    return res if keep_scores else res.drop(*names.values())


# ---------------------------------------------------------------------------
# M7: sub-label
# ---------------------------------------------------------------------------
def _clean_feature_columns(df: DataFrame) -> DataFrame:
    """Sub-label inputs as `_sv_<feature>`: null/NaN -> 0.5, absent column -> 0.0.
    Cleaning once in its own projection keeps the scoring code small."""
    fill = _number(P.SUB_LABEL_NULL_VALUE)
    return df.withColumns({f"_sv_{f}": F.expr(f"coalesce({_present(f)}, {fill})" if f in df.columns else _number(0))
                           for f in SUB_FEATURES})


def _terms(weights: list[tuple[str, float]]) -> list[str]:
    """w * v for w > 0, |w| * (1 - v) for w < 0 (sign folded at build time)."""
    out = []
    for feat, w in weights:
        v = f"_sv_{P.WEIGHT_COLUMN.get(feat, feat)}"
        out.append(f"{_number(w)} * {v}" if w >= 0 else f"{_number(abs(w))} * ({_number(1)} - {v})")
    return out


def _label_score(weights: list[tuple[str, float]], exact: bool) -> str:
    """The weighted sum, or with `exact` the largest running sum of its terms."""
    terms = _terms(weights)
    if not exact or len(terms) == 1:
        return " + ".join(terms)
    return "greatest(" + ", ".join(" + ".join(terms[:n]) for n in range(1, len(terms) + 1)) + ")"


def sub_label(df: DataFrame, family_col: str = "genre_family", out: str = "mood_cluster",
              exact: bool = False) -> DataFrame:
    """Weighted score of each sub-label of the row's family, first maximum wins.

    exact=False compares final sums; exact=True compares each label's best
    running (prefix) sum, which is what a score-inside-the-loop comparison
    yields.  They agree whenever feature values lie in [0, 1] (all terms are
    then non-negative); they differ for out-of-range inputs such as mode = 2.

    Plan shape: one projection cleans the inputs, the next computes the five
    scores of the row's own family (five small CASE columns, so generated code
    stays well under the 64 KB method limit), the last picks the first maximum
    and maps (family, position) to the label name.
    """
    n = max(len(v) for v in P.SUB_LABELS.values())
    scores = {}
    for k in range(n):
        # CASE stops at the row's family: only that family's sum is computed
        branches = " ".join(f"when {_text(fam)} then {_label_score(labels[k][2], exact)}"
                            for fam, labels in P.SUB_LABELS.items() if k < len(labels))
        scores[f"_ss{k}"] = F.expr(f"case `{family_col}` {branches} end")
    best = "greatest(" + ", ".join(scores) + ")"
    place = " ".join(f"when _ss{k} = {best} then {k}" for k in range(n))
    names = " ".join(f"when `{family_col}` = {_text(fam)} and _spos = {k} then {_text(name)}"
                     for fam, labels in P.SUB_LABELS.items() for k, (name, _, _) in enumerate(labels))
    res = (_clean_feature_columns(df).withColumns(scores).withColumn("_spos", F.expr(f"case {place} end"))
           .withColumn(out, F.expr(f"case {names} else {_text(P.UNKNOWN_LABEL)} end")))
    return res.drop(*[f"_sv_{f}" for f in SUB_FEATURES], *scores, "_spos")


def sub_label_exact(df: DataFrame, family_col: str = "genre_family", out: str = "mood_cluster") -> DataFrame:
    return sub_label(df, family_col, out, exact=True)


# ---------------------------------------------------------------------------
# M8/M9: whole classification and write-back
# ---------------------------------------------------------------------------
def classify_tracks(tracks: DataFrame, genre_col: str = "track_genre") -> DataFrame:
    """Normalise, attach the genre family, then sub-label (mood_cluster) and
    universal mood.  One narrow pipeline after the broadcast family join."""
    df = genre_family(normalize_features(tracks), genre_col)
    df = sub_label(df)
    return universal_mood(df)


def apply_mood_labels(table: DataFrame, labels: DataFrame, key: str = "track_id",
                      label_col: str = "mood_cluster") -> DataFrame:
    """Replace `label_col` of a gold table with the label of its key (null when
    the key has no label), keeping the table's column order."""
    cols = table.columns
    lab = labels.select(key, label_col)
    return table.drop(label_col).join(lab, key, "left").select(*cols)
