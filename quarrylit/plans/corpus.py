"""A text corpus derived from `part` by the same SQL in both engines: the value of every field follows from the row's numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarrylit.session import spread

_SQL = """SELECT p_partkey AS doc_id, p_size, p_retailprice, concat(
  'XRD with Cu Ka radiation, lambda = 1.', cast(5000 + p_partkey % 900 AS {s}), ' A. 2theta = ', cast(5 + p_size % 10 AS {s}), ' to ', cast(80 + p_size AS {s}),
  ' deg, step size 0.0', cast(1 + p_size % 9 AS {s}), ' deg. Space group No. ', cast(p_size * 5 - 4 AS {s}), '. ',
  CASE p_size % 4 WHEN 0 THEN 'Cubic FCC' WHEN 1 THEN 'tetragonal' WHEN 2 THEN 'Hexagonal hcp' ELSE 'monoclinic' END, ' phase. a = ',
  cast(cast(p_retailprice / 100 AS DECIMAL(10,3)) AS {s}), '(', cast(p_size % 9 + 1 AS {s}), ') A, c = ', cast(4 + p_size % 5 AS {s}), '.25 A, gamma = 120 deg, Z = ', cast(p_size % 8 + 1 AS {s}),
  '. Peaks (', cast(p_size % 3 AS {s}), cast(p_size % 2 AS {s}), '1) and (2 2 0). Refined with FullProf and GSAS-II at ', cast(20 + p_size AS {s}), ' C. ICSD ', cast(10000 + p_partkey AS {s}),
  ', mp-', cast(p_partkey AS {s}), '. Sample NiFe2O4 and TiO2 and TiO2 rutile. See arXiv 2401.', cast(10000 + p_partkey AS {s}), ' and 10.1000/x.', cast(p_partkey AS {s}), '. Reflection peak at ',
  cast(20 + p_size AS {s}), '.5 deg, FWHM = 0.', cast(10 + p_size AS {s}), ' with pseudo-Voigt profiles, X-ray density = ', cast(3 + p_size % 5 AS {s}), '.36 g/cm3, cell volume = ',
  cast(100 + p_size AS {s}), '.2(3) A3, Mw = ', cast(100 + p_size AS {s}), '.69 g/mol; Wyckoff position ', cast(p_size % 4 + 1 AS {s}), 'a and 8c sites; JCPDS 21-', cast(1000 + p_size AS {s}), '.') AS text
FROM part"""

#: For DuckDB, as a common table expression.
ORACLE = "corpus AS (" + _SQL.format(s="VARCHAR") + ")"


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spread(spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_size", "p_retailprice"), "p_partkey")
    return spark.sql(_SQL.format(s="STRING").replace("FROM part", "FROM {part}"), part=part)
