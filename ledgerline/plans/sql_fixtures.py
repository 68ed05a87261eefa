"""DuckDB statements of the expected clean rows, for the oracle checks.

They state the clean value of every cell directly from the tables; they
never re-implement the repair rules.
"""

# Clean SD cells per order; ``kind`` is the shift applied to the raw row.
SD_BASE = """
base AS (
  SELECT o.o_orderkey AS k, o.o_orderkey % 6 AS doc, (o.o_orderkey // 6) % 6 AS kind,
         CAST(o.o_orderdate AS DATE) AS od, o.o_orderstatus, o.o_orderpriority,
         c.c_custkey, c.c_name, c.c_mktsegment, c.c_nationkey, n.n_name
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
                JOIN nation n ON c.c_nationkey = n.n_nationkey
),
clean AS (
  SELECT k, kind, od,
    CASE doc WHEN 0 THEN 'RUC 20' WHEN 1 THEN 'PASAPORTE' WHEN 2 THEN 'CARNET EXT.'
             WHEN 3 THEN 'DNI' WHEN 4 THEN 'RUC PAS' END AS TIPO_DOC,
    CASE doc WHEN 0 THEN 'RUC' WHEN 1 THEN 'PT' WHEN 2 THEN 'CE' WHEN 3 THEN 'DNI'
             WHEN 4 THEN 'RUC' END AS TIPO_DOC_NORM,
    lpad(CAST(c_custkey AS VARCHAR), 11, '0') AS NRO_DOC,
    CASE WHEN kind IN (4, 5) THEN c_name || ',' || c_mktsegment || ',SA' ELSE c_name || ' SA' END
      AS NOMBRE_CLIENTE,
    CASE WHEN kind IN (4, 5) THEN NULL WHEN k % 13 = 0 THEN '00/00/0000'
         ELSE strftime(od - CAST(7300 + k % 9000 AS INTEGER), '%d/%m/%Y') END AS FECHA_NAC,
    o_orderstatus AS TIPO_ENTIDAD,
    CASE WHEN kind = 0 AND k % 7 = 0 THEN NULL ELSE strftime(od, '%d/%m/%Y') || ' 10:11:12' END
      AS FECHA_REG,
    o_orderpriority AS FUENTE,
    n_name AS NACIONALIDAD,
    c_mktsegment AS RAMOS,
    CAST(c_nationkey AS VARCHAR) AS COD_BROKER,
    'BK' || CASE WHEN kind = 5 THEN ',' ELSE ' ' END || CAST(c_nationkey AS VARCHAR) AS BROKER,
    strftime(od + 30, '%d/%m/%Y') AS VALIDO_DESDE,
    CASE WHEN kind = 5 THEN NULL WHEN k % 3 = 0 THEN NULL WHEN k % 3 = 1 THEN ''
         ELSE strftime(od + 365, '%d/%m/%Y') END AS VALIDO_HASTA,
    CASE WHEN kind IN (2, 4, 5) THEN NULL ELSE 'U' || CAST(k % 50 AS VARCHAR) END AS USUARIO,
    CASE WHEN kind = 0 THEN strftime(od + 1, '%d/%m/%Y') END AS REGISTRATION_DATE
  FROM base
),
rows_sd AS (
  SELECT * FROM clean UNION ALL SELECT * FROM clean WHERE k % 17 = 0
)
"""

SD_LOADED = """
loaded AS (
  SELECT DISTINCT TIPO_DOC_NORM AS TIPO_DOC, NRO_DOC, NOMBRE_CLIENTE,
    CAST(try_strptime(FECHA_NAC, '%d/%m/%Y') AS DATE) AS FECHA_NAC,
    TIPO_ENTIDAD, CAST(od AS TIMESTAMP) AS FECHA_REG, FUENTE, NACIONALIDAD, RAMOS, COD_BROKER,
    BROKER, USUARIO, CASE WHEN VALIDO_HASTA IS NULL OR VALIDO_HASTA = '' THEN 'A' ELSE 'C' END
      AS AGENCIAMIENTO,
    TIMESTAMP '2024-06-30 12:00:00' AS FECHA_DATA, 'etl-host/loader' AS USUARIO_DATA
  FROM rows_sd WHERE FECHA_REG IS NOT NULL AND od <= DATE '2000-01-01'
)
"""

OS_BASE = """
base AS (
  SELECT o.o_orderkey AS k, CAST(o.o_orderdate AS DATE) AS od, o.o_orderstatus,
         c.c_custkey, c.c_name, c.c_nationkey
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
                JOIN nation n ON c.c_nationkey = n.n_nationkey
),
clean AS (
  SELECT k, od,
    CAST(k AS INTEGER) AS ID,
    CASE k % 6 WHEN 0 THEN 'RUC 20' WHEN 1 THEN 'PASAPORTE' WHEN 2 THEN 'CARNET EXT.'
               WHEN 3 THEN 'DNI' WHEN 4 THEN 'RUC PAS' END AS TIPO_DOC,
    lpad(CAST(c_custkey AS VARCHAR), 11, '0') AS NRO_DOC,
    c_name AS NOMBRE_CLIENTE,
    CASE WHEN k % 23 = 0 THEN NULL ELSE od END AS FECHA_CREA,
    CASE WHEN k % 4 = 0 THEN od + 10
         WHEN k % 4 = 3 AND day(od + 10) >= 10 AND month(od + 10) >= 10 THEN od + 10 END AS FECHA_CARTA,
    'BK ' || CAST(c_nationkey AS VARCHAR) AS BROKER,
    CASE WHEN k % 5 = 1 THEN NULL ELSE 'U' || CAST(k % 50 AS VARCHAR) END AS USUARIO_CREA,
    CASE WHEN k % 6 = 2 THEN NULL ELSE 'C' || CAST(k % 30 AS VARCHAR) END AS USUARIO_CARTA,
    o_orderstatus AS ESTADO_CARTA
  FROM base
),
rows_os AS (
  SELECT * FROM clean UNION ALL SELECT * FROM clean WHERE k % 17 = 0
)
"""

# The loaded OS report: cut-off 2000-01-01, the run stamp of the registered checks.
OS_LOADED = f"""
WITH {OS_BASE}
SELECT DISTINCT ID, TIPO_DOC, NRO_DOC, NOMBRE_CLIENTE, FECHA_CREA, FECHA_CARTA, BROKER, USUARIO_CREA,
       USUARIO_CARTA, ESTADO_CARTA, TIMESTAMP '2024-06-30 12:00:00' AS FECHA_DATA,
       'etl-host/loader' AS USUARIO_DATA
FROM rows_os WHERE FECHA_CREA <= DATE '2000-01-01'
"""
