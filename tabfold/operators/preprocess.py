"""The survey preprocessing chain as a fitted Spark ML stage.

fit: null shares of the training rows (one aggregation) -> drop list.
transform: season codes -> optional -1 fill -> drop leaked / sparse columns
-> products and ratios (a feature whose input was dropped is skipped and
recorded in ``skipped``).  Nothing is recomputed from scoring batches.
"""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.ml.param.shared import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame

from tabfold.functions import columns as C
from tabfold.operators.profile import null_profile


def _pairs(d: dict) -> list[str]:
    return [f"{k}={a}:{b}" for k, (a, b) in d.items()]


def _unpairs(items: list[str]) -> dict:
    out = {}
    for it in items:
        k, ab = it.split("=", 1)
        a, b = ab.split(":", 1)
        out[k] = (a, b)
    return out


class SurveyPreprocessor(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    seasonMarker = Param(Params._dummy(), "seasonMarker", "name marker of season columns", TypeConverters.toString)
    dropPattern = Param(Params._dummy(), "dropPattern", "substring of leaked column names", TypeConverters.toString)
    maxNullPct = Param(Params._dummy(), "maxNullPct", "drop columns with more nulls (percent)", TypeConverters.toFloat)
    fillCols = Param(Params._dummy(), "fillCols", "columns given a -1 marker", TypeConverters.toListString)
    products = Param(Params._dummy(), "products", "name=a:b products", TypeConverters.toListString)
    ratios = Param(Params._dummy(), "ratios", "name=a:b ratios", TypeConverters.toListString)
    protect = Param(Params._dummy(), "protect", "never dropped (key, label)", TypeConverters.toListString)

    def __init__(self, seasonMarker="_Season", dropPattern="PCIAT_", maxNullPct=60.0, fillCols=None,
                 products=None, ratios=None, protect=None):
        super().__init__()
        self._setDefault(seasonMarker="_Season", dropPattern="PCIAT_", maxNullPct=60.0, fillCols=[],
                         products=[], ratios=[], protect=[])
        self._set(seasonMarker=seasonMarker, dropPattern=dropPattern, maxNullPct=maxNullPct,
                  fillCols=fillCols or [], products=_pairs(products if products is not None else C.SURVEY_PRODUCTS),
                  ratios=_pairs(ratios if ratios is not None else C.SURVEY_RATIOS), protect=protect or [])

    def _fit(self, df: DataFrame) -> "SurveyPreprocessorModel":
        prot = set(self.getOrDefault(self.protect))
        cols = [c for c in df.columns if c not in prot]
        lim = self.getOrDefault(self.maxNullPct)
        sparse = [r["column"] for r in null_profile(df, cols).where(f"null_pct > {lim}").collect()]
        m = SurveyPreprocessorModel()
        m._set(**{p.name: self.getOrDefault(p) for p in self.params if self.hasDefault(p) or self.isSet(p)})
        m._set(sparseCols=sparse)
        return m


class SurveyPreprocessorModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    seasonMarker = SurveyPreprocessor.seasonMarker
    dropPattern = SurveyPreprocessor.dropPattern
    maxNullPct = SurveyPreprocessor.maxNullPct
    fillCols = SurveyPreprocessor.fillCols
    products = SurveyPreprocessor.products
    ratios = SurveyPreprocessor.ratios
    protect = SurveyPreprocessor.protect
    sparseCols = Param(Params._dummy(), "sparseCols", "fitted sparse columns", TypeConverters.toListString)

    def __init__(self):
        super().__init__()
        self._setDefault(seasonMarker="_Season", dropPattern="PCIAT_", maxNullPct=60.0, fillCols=[],
                         products=[], ratios=[], protect=[], sparseCols=[])

    def skipped(self, columns: list[str]) -> list[str]:
        gone = set(self.getOrDefault(self.sparseCols))
        specs = {**_unpairs(self.getOrDefault(self.products)), **_unpairs(self.getOrDefault(self.ratios))}
        return [k for k, (a, b) in specs.items() if a in gone or b in gone or a not in columns or b not in columns]

    def _transform(self, df: DataFrame) -> DataFrame:
        d = C.encode_seasons(df, self.getOrDefault(self.seasonMarker))
        d = C.fill_constant(d, self.getOrDefault(self.fillCols), -1)
        prot = set(self.getOrDefault(self.protect))
        pat = self.getOrDefault(self.dropPattern)
        drop = [c for c in d.columns if c not in prot and ((pat and pat in c)
                                                           or c in set(self.getOrDefault(self.sparseCols)))]
        d = d.drop(*drop)
        d = C.feature_products(d, _unpairs(self.getOrDefault(self.products)))
        return C.feature_ratios(d, _unpairs(self.getOrDefault(self.ratios)))
