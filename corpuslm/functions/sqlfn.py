"""The map functions as temporary SQL functions, for use in spark.sql text."""

from __future__ import annotations

from pyspark.sql import SparkSession

UNIGRAM_LM = """
CREATE OR REPLACE TEMPORARY FUNCTION unigram_lm(freq MAP<STRING, DOUBLE>)
RETURNS MAP<STRING, DOUBLE>
RETURN transform(
  array(aggregate(map_values(freq), 0D, (a, x) -> a + x)),
  s -> transform_values(freq, (w, n) -> n / s))[0]
"""

# map_zip_with pairs the keys through a hash table, so the cost is linear in the sizes of the maps.
LM_SCORE = """
CREATE OR REPLACE TEMPORARY FUNCTION lm_score(
  prior DOUBLE, freq MAP<STRING, DOUBLE>, lm MAP<STRING, DOUBLE>, bg MAP<STRING, DOUBLE>, lambda DOUBLE)
RETURNS DOUBLE
RETURN CASE WHEN lambda > 0 AND lambda <= 1 THEN
  aggregate(
    map_values(map_zip_with(
      map_zip_with(freq, bg, (w, f, b) -> IF(f IS NULL, NULL, b)),
      lm,
      (w, b, p) -> IF(
        coalesce(b, 0D) <> 0D,
        ln(prior * ((1 - lambda) * coalesce(p, 0D) + lambda * b) / (lambda * b)),
        0D))),
    0D, (a, x) -> a + x)
ELSE raise_error('lambda must be above 0 and at most 1') END
"""


def register(spark: SparkSession) -> None:
    """Create unigram_lm(freq) and lm_score(prior, freq, lm, bg, lambda) in this session."""
    spark.sql(UNIGRAM_LM)
    spark.sql(LM_SCORE)
