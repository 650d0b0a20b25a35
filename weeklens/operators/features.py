"""Feature fitting as aggregates, feature transform as one SQL projection
(F1-F11).

``fit_features`` reads the training frame once into value histograms (one row
per column and distinct value) and works out medians, quantiles of the imputed
values, bin edges, and mean and population deviation of the clipped values from
those; a second pass counts categories for the modes. The fitted constants become one ``SQLTransformer`` statement, so the
transform is plain native expressions and is saved with the Spark ML
pipeline. Categoricals are indexed alphabetically with an unknown bucket and
one-hot encoded with that bucket dropped, so an unseen or missing category
is all zeros.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weeklens.operators.columns import choose_features
from weeklens.operators.ordered import histogram, quantiles
from weeklens.session import reliable_checkpoint

# The feature lists of the trainer and its default settings.
NUMERIC_FEATURES = ["region_id", "Y", "X", "num_deliver_per_week", "num_visit_per_week", "size"]
CATEGORICAL_FEATURES = ["customer_type", "brand", "category", "sub_category", "segment", "package"]
DISCRETIZE_FEATURES = ["num_deliver_per_week"]
# The full trainer's lists: regions and zones are categories there.
NUMERIC_FEATURES_FULL = ["Y", "X", "num_deliver_per_week", "num_visit_per_week", "size"]
CATEGORICAL_FEATURES_FULL = ["customer_type", "brand", "category", "sub_category", "segment", "package",
                             "region_id", "zone_id"]
DEFAULTS = {"n_bins": 7, "winsor_lower": 3, "winsor_upper": 97}
EDGE_TOLERANCE = 1e-8
WEEK_NAME = "__week"


@dataclass
class FeatureSpec:
    numeric: list
    discretize: list
    categorical: list
    week: bool
    n_bins: int = 7
    winsor_lower: float = 3
    winsor_upper: float = 97
    # "standard": median impute, winsorize, (x - mean) / population deviation;
    # "robust" (the production trainer, F6): median impute, (x - median) / IQR
    scaler: str = "standard"

    @classmethod
    def for_frame(cls, df: DataFrame, n_bins=7, winsor_lower=3, winsor_upper=97,
                  scaler: str = "standard"):
        have = set(df.columns)
        return cls([c for c in NUMERIC_FEATURES if c in have],
                   [c for c in DISCRETIZE_FEATURES if c in have],
                   [c for c in CATEGORICAL_FEATURES if c in have],
                   "week" in have, n_bins, winsor_lower, winsor_upper, scaler)

    @classmethod
    def full(cls, df: DataFrame, n_bins=9, winsor_lower=2, winsor_upper=100):
        """The full trainer's choice, falling back to all columns of a kind
        where fewer than two named ones exist."""
        num, cat = choose_features(df, NUMERIC_FEATURES_FULL, CATEGORICAL_FEATURES_FULL)
        have = set(df.columns)
        return cls(num, [c for c in DISCRETIZE_FEATURES if c in have], cat, "week" in have,
                   n_bins, winsor_lower, winsor_upper)


@dataclass
class FittedFeatures:
    spec: FeatureSpec
    median: dict = field(default_factory=dict)
    lower: dict = field(default_factory=dict)
    upper: dict = field(default_factory=dict)
    mean: dict = field(default_factory=dict)
    scale: dict = field(default_factory=dict)
    edges: dict = field(default_factory=dict)
    mode: dict = field(default_factory=dict)
    week_mean: float = 0.0
    week_scale: float = 1.0

    def as_dict(self) -> dict:
        return asdict(self)

    @classmethod
    def from_dict(cls, d: dict) -> "FittedFeatures":
        return cls(**{**d, "spec": FeatureSpec(**d["spec"])})

    # ---------------------------------------------------------------- transform
    def expressions(self) -> dict:
        """SQL of every prepared column by its name."""
        out = {}
        for c in self.spec.numeric:
            x = f"coalesce(nanvl(CAST(`{c}` AS DOUBLE), NULL), {_d(self.median[c])})"
            if self.spec.scaler == "standard":
                x = f"least(greatest({x}, {_d(self.lower[c])}), {_d(self.upper[c])})"
            out[f"__num_{c}"] = f"({x} - {_d(self.mean[c])}) / {_d(self.scale[c])}"
        for c in self.spec.discretize:
            inner = self.edges[c][1:-1]
            x = f"CAST(`{c}` AS DOUBLE)"
            terms = " + ".join(f"CASE WHEN {x} >= {_d(e)} THEN 1 ELSE 0 END" for e in inner) or "0"
            out[f"__disc_{c}"] = f"CAST(coalesce({terms}, 0) AS DOUBLE)"
        for c in self.spec.categorical:
            m = self.mode.get(c)
            fill = "NULL" if m is None else _s(m)
            out[f"__cat_{c}"] = f"coalesce(CAST(`{c}` AS STRING), {fill})"
        if self.spec.week:
            w = "coalesce(CAST(weekofyear(`week`) AS DOUBLE), 0.0)"
            out["__week"] = f"({w} - {_d(self.week_mean)}) / {_d(self.week_scale)}"
        return out

    def statement(self) -> str:
        parts = ["*", *[f"{x} AS `{name}`" for name, x in self.expressions().items()]]
        return "SELECT " + ", ".join(parts) + " FROM __THIS__"

    def vector(self, labels: dict):
        """The assembled vector as one native array: what the stages give, without a function call per stage.
        ``labels`` maps each categorical to its indexed labels; an unknown or missing one is all zeros."""
        return F.array(*[x for _, x in self.entries(labels)])

    def entries(self, labels: dict) -> list:
        """(column, expression) of every entry of the vector."""
        x = self.expressions()
        parts = [(c, F.expr(x[f"__num_{c}"])) for c in self.spec.numeric] + [(c, F.expr(x[f"__disc_{c}"])) for c in self.spec.discretize]
        for c in self.spec.categorical:
            held = F.expr(x[f"__cat_{c}"])
            parts += [(c, F.when(held == F.lit(v), 1.0).otherwise(0.0)) for v in labels.get(c, [])]
        if self.spec.week:
            parts.append(("week", F.expr(x["__week"])))
        return parts

    def stages(self, features_col: str = "features"):
        cats = self.spec.categorical
        stages = [SQLTransformer(statement=self.statement())]
        inputs = [f"__num_{c}" for c in self.spec.numeric]
        inputs += [f"__disc_{c}" for c in self.spec.discretize]
        if cats:
            stages.append(StringIndexer(inputCols=[f"__cat_{c}" for c in cats],
                                        outputCols=[f"__idx_{c}" for c in cats],
                                        handleInvalid="keep", stringOrderType="alphabetAsc"))
            stages.append(OneHotEncoder(inputCols=[f"__idx_{c}" for c in cats],
                                        outputCols=[f"__ohe_{c}" for c in cats], dropLast=True))
            inputs += [f"__ohe_{c}" for c in cats]
        if self.spec.week:
            inputs.append("__week")
        stages.append(VectorAssembler(inputCols=inputs, outputCol=features_col))
        return stages


def winsorize(df: DataFrame, cols, lower: float, upper: float, refit: bool = False,
              fitted: FittedFeatures | None = None) -> DataFrame:
    """F4 by itself: clip columns at percentiles. With ``refit`` the percentiles
    are those of ``df`` (each batch its own, as the reference's transformer
    does); otherwise the bounds of ``fitted`` are used. Nulls stay null."""
    if refit:
        q = {r.name: r.q for r in quantiles(
            histogram([(df, {c: F.col(c) for c in cols}, None)]), [lower / 100, upper / 100]).collect()}
        bounds = {c: (lo, hi if hi > lo else lo + 1e-6) for c, (lo, hi) in q.items()}
    else:
        bounds = {c: (fitted.lower[c], fitted.upper[c]) for c in cols}
    return df.withColumns({c: F.when(F.col(c).isNotNull(), F.least(F.greatest(
        F.col(c).cast("double"), F.lit(lo)), F.lit(hi))) for c, (lo, hi) in bounds.items()})


def _s(x: str) -> str:
    """A string as SQL: its UTF-8 bytes in hex, so that no character needs escaping."""
    return f"decode(X'{str(x).encode('utf-8').hex()}', 'UTF-8')"


def _d(x: float) -> str:
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def fit_features(df: DataFrame, spec: FeatureSpec) -> FittedFeatures:
    """F1, F2, F4-F7, F9 fitted on the rows of ``df``."""
    return fit_features_weighted([(df, None)], spec)


def _merge_edges(edges):
    """Drop each edge within the tolerance of the edge before it (bins of no
    width), as the quantile discretiser does; a constant column keeps one bin."""
    out = [e for i, e in enumerate(edges) if i == 0 or e - edges[i - 1] > EDGE_TOLERANCE]
    if len(out) == 1:
        out.append(out[0])
    return out


def feature_names(ff: FittedFeatures, labels: dict) -> list[str]:
    """names of the assembled vector; ``labels`` maps each categorical to
    its alphabetical labels. The k-th repetition of a name (the same column as
    number and as bins) is told apart by the suffix ``_k``."""
    groups = [ff.spec.numeric, ff.spec.discretize,
              *[[f"{c}_{v}" for v in labels.get(c, [])] for c in ff.spec.categorical],
              ["week"] * ff.spec.week]
    flat = [n for g in groups for n in g]
    earlier = [flat[:i].count(n) for i, n in enumerate(flat)]
    return [f"{n}_{k}" if k else n for n, k in zip(flat, earlier)]


def fitted_table(ff: FittedFeatures):
    """Rows (feature, stat, value) of everything fitted; strings as text."""
    rows = []
    for c in ff.spec.numeric:
        rows.append((c, "median", ff.median[c], None))
        if ff.spec.scaler == "standard":
            rows += [(c, "winsor_lower", ff.lower[c], None), (c, "winsor_upper", ff.upper[c], None)]
        rows += [(c, "center" if ff.spec.scaler == "robust" else "mean", ff.mean[c], None),
                 (c, "scale", ff.scale[c], None)]
    for c in ff.spec.discretize:
        rows += [(c, f"edge_{i}", e, None) for i, e in enumerate(ff.edges[c])]
    for c in ff.spec.categorical:
        rows.append((c, "mode", None, ff.mode[c]))
    if ff.spec.week:
        rows += [("week", "mean", ff.week_mean, None), ("week", "scale", ff.week_scale, None)]
    return rows


def fit_features_weighted(parts, spec: FeatureSpec) -> FittedFeatures:
    """The fit from tables whose rows each stand for ``w`` rows of the training
    frame: ``parts`` is a list of (frame, weight column or None). Each feature
    is fitted on the part that holds it. A dense grid's training split is its
    customer spine (weight products x weeks), product list (customers x weeks)
    and week table (customers x products).

    The frames are read once into a histogram (value, count) per column;
    medians, quantiles, bin edges and moments are worked out from it, with
    nulls and NaN counted at the median as the imputer puts them there."""
    ff = FittedFeatures(spec)

    def owner(c):
        for i, (df, _) in enumerate(parts):
            if c in df.columns:
                return i
        raise KeyError(c)

    wanted: dict = {}
    for c in dict.fromkeys([*spec.numeric, *spec.discretize]):
        wanted.setdefault(owner(c), {})[c] = F.col(c)
    if spec.week:
        wanted.setdefault(owner("week"), {})[WEEK_NAME] = F.coalesce(
            F.weekofyear("week").cast("double"), F.lit(0.0))
    weight = [None if w is None else F.col(w) for _, w in parts]
    if wanted:
        hist = reliable_checkpoint(histogram([(parts[i][0], cols, weight[i])
                                              for i, cols in sorted(wanted.items())]))
        _fit_numbers(hist, ff)
    if spec.categorical:
        counts = None
        for c in spec.categorical:
            i = owner(c)
            n = F.count("*") if weight[i] is None else F.sum(weight[i])
            part = (parts[i][0].where(F.col(c).isNotNull())
                    .groupBy(F.lit(c).alias("name"), F.col(c).cast("string").alias("v"))
                    .agg(n.cast("long").alias("n")))
            counts = part if counts is None else counts.unionByName(part)
        top = counts.groupBy("name").agg(F.min_by("v", F.struct(-F.col("n"), F.col("v"))).alias("v"))
        ff.mode = {c: None for c in spec.categorical} | {r.name: r.v for r in top.collect()}
    return ff


def _fit_numbers(hist: DataFrame, ff: FittedFeatures) -> None:
    """Medians, edges, clipping bounds and moments from a checkpointed histogram.
    Every collected table has one row per column."""
    spec = ff.spec
    probs = [i / spec.n_bins for i in range(spec.n_bins + 1)]
    q = {r.name: r.q for r in quantiles(hist, [0.5, *probs], checkpointed=True).collect()}
    ff.median = {c: q[c][0] if c in q else 0.0 for c in spec.numeric}
    for c in spec.discretize:
        ff.edges[c] = _merge_edges(q[c][1:] if c in q else [0.0, 0.0])
    names = [*spec.numeric, *([WEEK_NAME] if spec.week else [])]
    if not names:
        return
    fill = F.create_map(*[x for c in names for x in (F.lit(c), F.lit(float(ff.median.get(c, 0.0))))])
    full = (hist.where(F.col("name").isin(names)).withColumn("v", F.coalesce("v", fill[F.col("name")]))
            .groupBy("name", "v").agg(F.sum("n").alias("n")))
    robust = spec.scaler == "robust"
    ranks = [0.25, 0.5, 0.75] if robust else [spec.winsor_lower / 100, spec.winsor_upper / 100]
    if spec.numeric:
        for r in quantiles(full.where(F.col("name").isin(spec.numeric)), ranks).collect():
            if robust:
                iqr = r.q[2] - r.q[0]
                ff.mean[r.name], ff.scale[r.name] = r.q[1], iqr if iqr > 0 else 1.0
                ff.lower[r.name], ff.upper[r.name] = float("-inf"), float("inf")
            else:
                ff.lower[r.name] = r.q[0]
                ff.upper[r.name] = r.q[1] if r.q[1] > r.q[0] else r.q[0] + 1e-6
    moments = [WEEK_NAME] if robust and spec.week else [] if robust else names
    if moments:
        low = F.create_map(*[x for c in moments for x in (F.lit(c), F.lit(float(ff.lower.get(c, float("-inf")))))])
        high = F.create_map(*[x for c in moments for x in (F.lit(c), F.lit(float(ff.upper.get(c, float("inf")))))])
        x = full.where(F.col("name").isin(moments)).withColumn(
            "v", F.least(F.greatest("v", low[F.col("name")]), high[F.col("name")]))
        total = x.groupBy("name").agg(F.sum("n").alias("n"), (F.sum(F.col("v") * F.col("n")) / F.sum("n")).alias("m"))
        spread = (x.join(F.broadcast(total.select("name", "m")), "name").groupBy("name")
                  .agg((F.sum((F.col("v") - F.col("m")) ** 2 * F.col("n")) / F.sum("n")).alias("var"),
                       F.first("m").alias("m")))
        for r in spread.collect():
            scale = r["var"] ** 0.5 if r["var"] and r["var"] > 0 else 1.0
            if r.name == WEEK_NAME:
                ff.week_mean, ff.week_scale = r.m, scale
            else:
                ff.mean[r.name], ff.scale[r.name] = r.m, scale
    for c in spec.numeric:
        ff.mean.setdefault(c, 0.0)
        ff.scale.setdefault(c, 1.0)
        ff.lower.setdefault(c, 0.0)
        ff.upper.setdefault(c, 1e-6)
