"""The queries of ``queries`` as plain SQL, each in its most direct form.

Counts of distinct values, joins at line level and the like are left as they
read, so that the two sides share no rewrite.
"""

from __future__ import annotations

from vinilo.sources.retail import GENRES, MAIN_GENRES, NOBODY

VIEWS = f"""
WITH v_invoice AS (
  SELECT o_orderkey AS InvoiceId, o_custkey AS CustomerId,
         CAST(o_orderdate AS DATE) AS fecha, o_orderpriority AS BillingCity,
         o_orderstatus AS BillingState, CAST(o_totalprice AS DECIMAL(12,2)) AS Total
  FROM orders),
v_line AS (
  SELECT (l_orderkey * 10 + l_linenumber) * 1000 + l_partkey % 1000 AS InvoiceLineId,
         l_orderkey AS InvoiceId,
         l_partkey AS TrackId, CAST(l_extendedprice AS DECIMAL(12,2)) AS UnitPrice,
         CAST(l_quantity AS INTEGER) AS Quantity
  FROM lineitem),
v_track AS (
  SELECT p_partkey AS TrackId, p_name AS Name, p_brand AS AlbumId,
         p_size % 6 AS MediaTypeId, p_type AS GenreId, p_size * 7919 AS Milliseconds,
         CAST(p_retailprice AS DECIMAL(12,2)) AS UnitPrice
  FROM part),
v_album AS (
  SELECT DISTINCT p_brand AS AlbumId, p_brand AS Title,
         CAST(regexp_extract(p_brand, '(\\d+)', 1) AS INTEGER) AS ArtistId
  FROM part),
v_artist AS (SELECT n_nationkey AS ArtistId, n_name AS Name FROM nation),
v_genre AS (SELECT DISTINCT p_type AS GenreId, p_type AS Name FROM part),
v_media AS (SELECT r_regionkey AS MediaTypeId, r_name AS Name FROM region),
v_customer AS (
  SELECT c_custkey AS CustomerId, c_mktsegment AS FirstName, c_name AS LastName,
         c_mktsegment AS Company, n_name AS Country,
         lower(replace(c_name, '#', '.')) || '@mail.test' AS Email,
         CASE WHEN c_custkey % 13 <> 0 THEN c_custkey % 10 END AS SupportRepId
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
v_employee AS (
  SELECT s_suppkey AS EmployeeId, s_name AS FirstName, s_name AS LastName,
         'rep' AS Title, CASE WHEN s_suppkey >= 3 THEN s_suppkey // 3 END AS ReportsTo
  FROM supplier),
v_cart AS (
  SELECT o_orderkey AS CheckoutId,
         o_custkey + CASE WHEN o_orderkey % 101 = 0 THEN {NOBODY} ELSE 0 END AS CustomerId,
         o_orderpriority AS BillingCity
  FROM orders),
v_item AS (
  SELECT l_orderkey AS CheckoutId,
         CAST(l_linenumber AS BIGINT) * 1000000000000 + l_partkey AS Seq,
         l_partkey + CASE WHEN l_orderkey % 97 = 0 THEN {NOBODY} ELSE 0 END AS TrackId,
         CASE WHEN l_orderkey % 89 = 0 THEN 0 WHEN l_orderkey % 83 = 0 THEN 101
              ELSE CAST(l_quantity AS INTEGER) END AS Quantity,
         CAST(CAST(p_retailprice AS DECIMAL(12,2))
              + CASE WHEN l_orderkey % 7 = 0 THEN 1 ELSE 0 END AS DECIMAL(12,2)) AS UnitPrice
  FROM lineitem JOIN part ON l_partkey = p_partkey),
v_sold AS (
  SELECT l.InvoiceId, l.TrackId, l.UnitPrice, l.Quantity, i.CustomerId, i.fecha,
         CAST(date_trunc('month', i.fecha) AS DATE) AS mes, t.AlbumId, b.ArtistId, a.Name
  FROM v_line l JOIN v_invoice i ON l.InvoiceId = i.InvoiceId
  LEFT JOIN v_track t ON l.TrackId = t.TrackId
  LEFT JOIN v_album b ON t.AlbumId = b.AlbumId
  LEFT JOIN v_artist a ON b.ArtistId = a.ArtistId),
v_bought AS (
  SELECT i.CustomerId, l.UnitPrice AS price, t.Milliseconds AS duration, g.Name AS genre
  FROM v_line l JOIN v_invoice i ON l.InvoiceId = i.InvoiceId
  JOIN v_track t ON l.TrackId = t.TrackId JOIN v_genre g ON t.GenreId = g.GenreId)
"""

MEASURES = """
count(TrackId) AS total_canciones_vendidas,
CAST(sum(Quantity) AS BIGINT) AS cantidad_total,
count(DISTINCT InvoiceId) AS numero_facturas,
count(DISTINCT CustomerId) AS clientes_unicos,
CAST(sum(UnitPrice * Quantity) AS DOUBLE) AS monto_total
"""

RATIOS = """
total_canciones_vendidas / numero_facturas AS avg_canciones_por_factura,
monto_total / numero_facturas AS ticket_promedio
"""

DAY_PARTS = """
dayname(fecha) AS dia_semana, CAST(month(fecha) AS INTEGER) AS mes,
CAST(year(fecha) AS INTEGER) AS "año", CAST(quarter(fecha) AS INTEGER) AS trimestre
"""

MONTH_PARTS = """
CAST(year(mes) AS INTEGER) AS "año", CAST(month(mes) AS INTEGER) AS numero_mes,
monthname(mes) AS nombre_mes
"""

DAILY = f"""
, by_day AS (SELECT fecha, {MEASURES} FROM v_sold GROUP BY fecha),
daily AS (SELECT *, {DAY_PARTS}, {RATIOS} FROM by_day)
"""

MONTHLY = f"""
, by_month AS (
  SELECT strftime(fecha, '%Y-%m') AS year_month, {MEASURES} FROM v_sold GROUP BY 1),
monthly AS (SELECT *, {RATIOS} FROM by_month)
"""

ARTISTS = f"""
, artist_month AS (
  SELECT mes, ArtistId, Name, {MEASURES}, count(DISTINCT AlbumId) AS albums_vendidos,
         Name AS nombre_artista, {MONTH_PARTS}
  FROM v_sold GROUP BY mes, ArtistId, Name),
totals AS (
  SELECT mes AS m, CAST(sum(total_canciones_vendidas) AS BIGINT) AS total_mes_canciones,
         CAST(sum(CAST(monto_total AS DECIMAL(30,2))) AS DOUBLE) AS total_mes_monto
  FROM artist_month GROUP BY mes),
ranked AS (
  SELECT *, CAST(row_number() OVER (
    PARTITION BY mes ORDER BY total_canciones_vendidas DESC, ArtistId NULLS LAST,
    Name NULLS LAST) AS INTEGER) AS rk
  FROM artist_month),
top_artists AS (
  SELECT ranked.*, total_mes_canciones, total_mes_monto,
         total_canciones_vendidas / total_mes_canciones * 100 AS porcentaje_canciones,
         monto_total / total_mes_monto * 100 AS porcentaje_monto,
         monto_total / total_canciones_vendidas AS precio_promedio_cancion
  FROM ranked JOIN totals ON mes = m)
"""

BASIC = """
count(*) AS total_purchases, CAST(sum(price) AS DOUBLE) AS total_spent,
CAST(sum(price) AS DOUBLE) / count(price) AS avg_track_price,
CAST(sum(duration) AS DOUBLE) / count(duration) AS avg_track_duration,
count(DISTINCT genre) AS unique_genres
"""

_MAIN = ", ".join(f"'{g}'" for g in MAIN_GENRES)
SHARES = ",\n".join(
    f"count(*) FILTER (genre = '{g}') / count(*) * 100 AS {g.lower()}_percentage"
    for g in MAIN_GENRES
) + f",\ncount(*) FILTER (genre NOT IN ({_MAIN})) / count(*) * 100 AS other_percentage"

FEATURES = f"""
, features AS (
  SELECT c.CustomerId, c.FirstName, c.LastName, c.Country, f.* EXCLUDE (CustomerId)
  FROM v_customer c JOIN (
    SELECT CustomerId, {BASIC}, {SHARES} FROM v_bought GROUP BY CustomerId) f
  ON c.CustomerId = f.CustomerId)
"""

_FEATURE_NAMES = [
    "total_purchases",
    "total_spent",
    "avg_track_price",
    "avg_track_duration",
    "unique_genres",
    *[f"{g.lower()}_percentage" for g in MAIN_GENRES],
    "other_percentage",
]

SCALED = ",\n".join(
    f"coalesce(round_even(({c} - avg({c}) OVER ()) / nullif(stddev_samp({c}) OVER (), 0)"
    f" * 1e6, 0) / 1e6, 0) AS {c}"
    for c in _FEATURE_NAMES
)

BUYERS = """(SELECT count(DISTINCT CustomerId) FROM v_bought
  WHERE CustomerId IN (SELECT CustomerId FROM v_customer))"""

# Every pair of customers is compared.
_STANDARD = ", ".join(
    f"coalesce(({c} - avg({c}) OVER ()) / nullif(stddev_samp({c}) OVER (), 0), 0) AS {c}"
    for c in _FEATURE_NAMES
)
_APART = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in _FEATURE_NAMES)
COUNTRY_SILHOUETTES = f"""
, standard AS (SELECT CustomerId, Country, {_STANDARD} FROM features),
apart AS (
  SELECT a.CustomerId, a.Country, b.Country AS other, sum({_APART}) AS total, count(*) AS n
  FROM standard a JOIN standard b ON a.CustomerId <> b.CustomerId GROUP BY ALL),
rated AS (
  SELECT s.CustomerId, s.Country, min(total / n) FILTER (a.Country = other) AS inside,
    min(total / n) FILTER (a.Country <> other) AS outside
  FROM standard s LEFT JOIN apart a ON s.CustomerId = a.CustomerId GROUP BY ALL)
SELECT Country, count(*) AS customers,
  round_even(avg(CASE WHEN outside IS NULL THEN NULL WHEN inside IS NULL THEN 0
    ELSE coalesce((outside - inside) / nullif(greatest(inside, outside), 0), 0) END) * 1e6, 0)
    / 1e6 + 0.0 AS silhouette
FROM rated GROUP BY Country"""

CHECKOUT = """
, item_facts AS (
  SELECT x.*, t.UnitPrice AS catalog_price
  FROM v_item x LEFT JOIN v_track t ON x.TrackId = t.TrackId),
per_cart AS (
  SELECT CheckoutId,
         bool_or(NOT coalesce(TrackId > 0, false)) AS bad_track,
         bool_or(NOT coalesce(Quantity BETWEEN 1 AND 100, false)) AS bad_quantity,
         bool_or(NOT coalesce(UnitPrice > 0, false)) AS bad_price,
         min(Seq) FILTER (catalog_price IS NULL) AS unknown_seq,
         count(*) FILTER (UnitPrice <> catalog_price) AS RepricedItems,
         CAST(sum(catalog_price * Quantity) AS DOUBLE) AS Total
  FROM item_facts GROUP BY CheckoutId),
judged AS (
  SELECT c.*, RepricedItems, Total, unknown_seq,
         concat_ws(',',
           CASE WHEN NOT coalesce(c.CustomerId > 0, false) THEN 'customer_id' END,
           CASE WHEN p.CheckoutId IS NULL THEN 'items' END,
           CASE WHEN length(BillingCity) > 40 THEN 'BillingCity' END,
           CASE WHEN bad_track THEN 'track_id' END,
           CASE WHEN bad_quantity THEN 'quantity' END,
           CASE WHEN bad_price THEN 'unit_price' END)
         AS failed_rules,
         k.CustomerId AS known_customer
  FROM v_cart c LEFT JOIN per_cart p ON c.CheckoutId = p.CheckoutId
  LEFT JOIN v_customer k ON c.CustomerId = k.CustomerId),
reasoned AS (
  SELECT *, CASE WHEN failed_rules <> '' THEN 'invalid_request'
                 WHEN known_customer IS NULL THEN 'customer_not_found'
                 WHEN unknown_seq IS NOT NULL THEN 'track_not_found' END AS reason
  FROM judged)
"""

AUDIT_TABLES = f"""
, a_customer AS (
  SELECT * REPLACE (CASE WHEN CustomerId % 3 = 0 THEN 'shared@mail.test' ELSE Email END
                    AS Email) FROM v_customer),
a_line AS (
  SELECT * REPLACE (InvoiceId + CASE WHEN InvoiceId % 500 = 0 THEN {NOBODY} ELSE 0 END
                    AS InvoiceId) FROM v_line)
"""


def _row_rule(table: str, view: str, rule: str, condition: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{rule}' AS rule, "
        f"count(*) FILTER ({condition}) AS violations FROM {view}"
    )


def _unique(table: str, view: str, column: str) -> str:
    return (
        f"SELECT '{table}', '{column} unique', count({column}) - count(DISTINCT {column}) "
        f"FROM {view}"
    )


def _reference(table: str, view: str, column: str, parent: str, parent_view: str, key: str) -> str:
    return (
        f"SELECT '{table}', '{column} references {parent}', count(*) FROM {view} c "
        f"WHERE {column} IS NOT NULL AND NOT EXISTS "
        f"(SELECT 1 FROM {parent_view} p WHERE p.{key} = c.{column})"
    )


def _audit() -> str:
    views = {
        "Album": "v_album",
        "Artist": "v_artist",
        "Customer": "a_customer",
        "Employee": "v_employee",
        "Genre": "v_genre",
        "Invoice": "v_invoice",
        "InvoiceLine": "a_line",
        "MediaType": "v_media",
        "Track": "v_track",
    }
    required = {
        "Album": "AlbumId Title ArtistId",
        "Artist": "ArtistId Name",
        "Customer": "CustomerId FirstName LastName Email",
        "Employee": "EmployeeId LastName FirstName",
        "Genre": "GenreId Name",
        "Invoice": "InvoiceId CustomerId InvoiceDate Total",
        "InvoiceLine": "InvoiceLineId InvoiceId TrackId UnitPrice Quantity",
        "MediaType": "MediaTypeId Name",
        "Track": "TrackId Name MediaTypeId Milliseconds UnitPrice",
    }
    lengths = {
        "Album": {"Title": 160},
        "Artist": {"Name": 120},
        "Customer": {"FirstName": 40, "LastName": 20, "Company": 80, "Country": 40, "Email": 60},
        "Employee": {"LastName": 20, "FirstName": 20, "Title": 30},
        "Genre": {"Name": 120},
        "Invoice": {"BillingCity": 40, "BillingState": 40},
        "MediaType": {"Name": 120},
        "Track": {"Name": 200},
    }
    parts = [
        _row_rule(
            table,
            view,
            f"{column} not null",
            f"{'fecha' if column == 'InvoiceDate' else column} IS NULL",
        )
        for table, view in views.items()
        for column in required[table].split()
    ]
    parts += [
        _row_rule(table, views[table], f"{column} length {n}", f"length({column}) > {n}")
        for table, columns in lengths.items()
        for column, n in columns.items()
    ]
    parts += [
        _unique(table, view, required[table].split()[0])
        for table, view in views.items()
    ]
    parts.append(_unique("Customer", "a_customer", "Email"))
    parts += [
        _reference(child, views[child], column, parent, views[parent], key)
        for child, column, parent, key in (
            ("Album", "ArtistId", "Artist", "ArtistId"),
            ("Track", "AlbumId", "Album", "AlbumId"),
            ("Track", "MediaTypeId", "MediaType", "MediaTypeId"),
            ("Track", "GenreId", "Genre", "GenreId"),
            ("Employee", "ReportsTo", "Employee", "EmployeeId"),
            ("Customer", "SupportRepId", "Employee", "EmployeeId"),
            ("Invoice", "CustomerId", "Customer", "CustomerId"),
            ("InvoiceLine", "InvoiceId", "Invoice", "InvoiceId"),
            ("InvoiceLine", "TrackId", "Track", "TrackId"),
        )
    ]
    return VIEWS + AUDIT_TABLES + " UNION ALL ".join(parts)


def _table_counts(prefix: str, twice: tuple[str, ...] = ()) -> str:
    views = {
        "Album": "v_album",
        "Artist": "v_artist",
        "Customer": "v_customer",
        "Employee": "v_employee",
        "Genre": "v_genre",
        "Invoice": "v_invoice",
        "InvoiceLine": "v_line",
        "MediaType": "v_media",
        "Track": "v_track",
    }
    return VIEWS + " UNION ALL ".join(
        f"SELECT '{prefix + table.lower() if prefix else table}' AS table_name, "
        f"count(*){' * 2' if table in twice else ''} AS row_count FROM {view}"
        for table, view in views.items()
    )


def _iso_dates(sql: str, *columns: str) -> str:
    """Show date columns as text, as the queries do."""
    replaced = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in columns)
    return sql.replace("SELECT * FROM", f"SELECT * REPLACE ({replaced}) FROM")


_PRICE_TEXTS = """
, price_texts AS (
  SELECT InvoiceLineId, CASE InvoiceId % 7
    WHEN 0 THEN CAST(UnitPrice AS VARCHAR) || 'abc'
    WHEN 1 THEN ''
    WHEN 2 THEN 'abc'
    WHEN 3 THEN NULL
    WHEN 4 THEN '  -' || CAST(UnitPrice AS VARCHAR)
    WHEN 5 THEN CAST(UnitPrice AS VARCHAR) || 'e1'
    ELSE CAST(UnitPrice AS VARCHAR) END AS text
  FROM v_line),
parsed AS (
  SELECT InvoiceLineId, text, coalesce(try_cast(regexp_extract(text,
    '^\\s*([+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?)', 1) AS DOUBLE), 0) AS price
  FROM price_texts)
"""

ORACLE: dict[str, str] = {
    "sales_per_day": _iso_dates(VIEWS + DAILY + "SELECT * FROM daily", "fecha"),
    "sales_per_day_rounded": VIEWS + DAILY + """
        SELECT * REPLACE (CAST(fecha AS VARCHAR) AS fecha,
          round_even(avg_canciones_por_factura * 100, 0) / 100 AS avg_canciones_por_factura,
          round_even(ticket_promedio * 100, 0) / 100 AS ticket_promedio) FROM daily""",
    "sales_by_weekday": VIEWS + f"""
        SELECT *, {RATIOS} FROM (
          SELECT dayname(fecha) AS dia_semana, {MEASURES} FROM v_sold GROUP BY 1)""",
    "sales_by_month": VIEWS + MONTHLY + "SELECT * FROM monthly",
    "sales_valid_dates": VIEWS + """
        SELECT CAST(d AS VARCHAR) AS fecha, count(*) AS facturas FROM (
          SELECT CAST(try_cast(CASE WHEN InvoiceId % 50 = 0 THEN 'bad'
            ELSE CAST(fecha AS VARCHAR) END AS TIMESTAMP) AS DATE) AS d FROM v_invoice)
        WHERE d IS NOT NULL GROUP BY 1""",
    "date_parts": VIEWS + f"""
        SELECT DISTINCT CAST(fecha AS VARCHAR) AS fecha, {DAY_PARTS},
          monthname(fecha) AS nombre_mes, strftime(fecha, '%Y-%m') AS year_month,
          CAST(CAST(date_trunc('month', fecha) AS DATE) AS VARCHAR) AS inicio_mes
        FROM v_invoice""",
    "artist_sales_attribution": VIEWS + """
        SELECT b.ArtistId, a.Name, count(l.TrackId) AS lineas,
               CAST(sum(Quantity) AS BIGINT) AS cantidad
        FROM v_line l LEFT JOIN v_track t ON l.TrackId = t.TrackId
        LEFT JOIN v_album b ON t.AlbumId = b.AlbumId
        LEFT JOIN v_artist a ON b.ArtistId = a.ArtistId GROUP BY ALL""",
    "artist_month_metrics": _iso_dates(VIEWS + ARTISTS + "SELECT * FROM artist_month", "mes"),
    "artist_month_metrics_attributed": _iso_dates(
        VIEWS
        + ARTISTS
        + "SELECT * FROM artist_month WHERE ArtistId IS NOT NULL AND Name IS NOT NULL",
        "mes",
    ),
    "artist_month_metrics_flat": VIEWS + f"""
        SELECT CAST(mes AS VARCHAR) AS mes, ArtistId, count(*) AS total_canciones_vendidas,
          CAST(sum(Quantity) AS BIGINT) AS cantidad_total,
          CAST(sum(UnitPrice * Quantity) AS DOUBLE) AS monto_total,
          count(DISTINCT TrackId) AS numero_facturas,
          count(DISTINCT TrackId) AS clientes_unicos, {MONTH_PARTS}
        FROM v_sold GROUP BY v_sold.mes, ArtistId""",
    "month_totals": VIEWS + """
        SELECT CAST(mes AS VARCHAR) AS mes, count(TrackId) AS total_mes_canciones,
               CAST(sum(UnitPrice * Quantity) AS DOUBLE) AS total_mes_monto
        FROM v_sold GROUP BY v_sold.mes""",
    "top_artist_per_month": VIEWS + ARTISTS + """
        SELECT * EXCLUDE (rk) REPLACE (CAST(mes AS VARCHAR) AS mes)
        FROM top_artists WHERE rk = 1""",
    "top5_artists_per_month": _iso_dates(
        VIEWS + ARTISTS + "SELECT * FROM top_artists WHERE rk <= 5", "mes"
    ),
    "report_latest_days": VIEWS + DAILY + """
        SELECT CAST(fecha AS VARCHAR) AS fecha, total_canciones_vendidas, monto_total
        FROM daily ORDER BY daily.fecha DESC LIMIT 10""",
    "report_days_after": VIEWS + DAILY + """
        SELECT * REPLACE (CAST(fecha AS VARCHAR) AS fecha) FROM daily
        WHERE daily.fecha > DATE '2000-01-01'""",
    "report_top_artists": VIEWS + ARTISTS + """
        SELECT CAST(mes AS VARCHAR) AS mes, nombre_artista, total_canciones_vendidas
        FROM top_artists WHERE rk = 1""",
    "weekend_comparison": VIEWS + f"""
        SELECT *, {RATIOS} FROM (
          SELECT isodow(fecha) >= 6 AS fin_de_semana, {MEASURES},
                 count(DISTINCT fecha) AS numero_dias FROM v_sold GROUP BY 1)""",
    "weekday_normalized": VIEWS + DAILY + """
        SELECT dia_semana, count(*) AS numero_dias,
          CAST(sum(total_canciones_vendidas) AS DOUBLE) / count(*)
            AS total_canciones_vendidas_por_dia,
          CAST(sum(cantidad_total) AS DOUBLE) / count(*) AS cantidad_total_por_dia,
          CAST(sum(numero_facturas) AS DOUBLE) / count(*) AS numero_facturas_por_dia,
          CAST(sum(clientes_unicos) AS DOUBLE) / count(*) AS clientes_unicos_por_dia,
          CAST(sum(CAST(monto_total AS DECIMAL(30,2))) AS DOUBLE) / count(*)
            AS monto_total_por_dia
        FROM daily GROUP BY dia_semana""",
    "month_ranking": VIEWS + MONTHLY + """
        SELECT *, CAST(rank() OVER (ORDER BY total_canciones_vendidas DESC) AS INTEGER)
          AS ranking FROM monthly""",
    "best_month_per_year": VIEWS + MONTHLY + """
        SELECT * EXCLUDE (rk) FROM (
          SELECT *, row_number() OVER (PARTITION BY substr(year_month, 1, 4)
            ORDER BY total_canciones_vendidas DESC, year_month) AS rk,
            CAST(substr(year_month, 1, 4) AS INTEGER) AS "año" FROM monthly) WHERE rk = 1""",
    "quarter_ranking": VIEWS + f"""
        SELECT *, {RATIOS},
          CAST(rank() OVER (ORDER BY total_canciones_vendidas DESC) AS INTEGER) AS ranking
        FROM (SELECT CAST(year(fecha) AS INTEGER) AS "año",
                CAST(quarter(fecha) AS INTEGER) AS trimestre, {MEASURES}
              FROM v_sold GROUP BY 1, 2)""",
    "month_trend": VIEWS + MONTHLY + """
        SELECT year_month, total_canciones_vendidas, monto_total,
          lag(monto_total) OVER w AS monto_anterior,
          (monto_total - lag(monto_total) OVER w) / lag(monto_total) OVER w * 100
            AS cambio_porcentual,
          avg(monto_total) OVER (ORDER BY year_month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
            AS media_movil_3
        FROM monthly WINDOW w AS (ORDER BY year_month)""",
    "month_trend_with_gaps": VIEWS + """
, months AS (
  SELECT strftime(fecha, '%Y-%m') AS year_month, year(fecha) * 12 + month(fecha) AS m,
    count(TrackId) AS total_canciones_vendidas,
    CAST(sum(UnitPrice * Quantity) AS DOUBLE) AS monto_total
  FROM v_sold WHERE month(fecha) <> 3 AND (year(fecha) * 12 + month(fecha)) % 7 <> 0 GROUP BY 1, 2)
        SELECT a.year_month, a.total_canciones_vendidas, a.monto_total,
          b.monto_total AS monto_anterior,
          (a.monto_total - b.monto_total) / b.monto_total * 100 AS cambio_porcentual,
          avg(a.monto_total) OVER (ORDER BY a.m RANGE BETWEEN 2 PRECEDING AND CURRENT ROW)
            AS media_movil_3
        FROM months a LEFT JOIN months b ON b.m = a.m - 1""",
    "sales_dropped_dates": """
        SELECT count(*) AS invoices,
          count(*) FILTER (o_orderkey % 50 <> 0 AND o_orderkey % 70 = 0) AS without_date,
          count(*) FILTER (o_orderkey % 50 = 0) AS unreadable,
          CAST(sum(CAST(o_totalprice AS DECIMAL(12, 2)))
            FILTER (o_orderkey % 50 = 0 OR o_orderkey % 70 = 0) AS DOUBLE) AS dropped_amount
        FROM orders""",
    "catalog_widened": """
        SELECT o_custkey AS CustomerId, 2 * count(*) AS facturas,
          CAST(sum(CAST(o_totalprice AS DECIMAL(12, 2))
            + CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS DECIMAL(10, 1))) AS DOUBLE) AS total,
          CAST(max(o_orderdate) AS VARCHAR) AS ultima
        FROM orders GROUP BY o_custkey""",
    "customer_employee_history": VIEWS + """
        SELECT c.CustomerId, c.FirstName AS CustomerFirstName, c.LastName AS CustomerLastName,
          c.Email AS CustomerEmail, c.Company, c.Country AS CustomerCountry, c.SupportRepId,
          e.FirstName AS EmployeeFirstName, e.LastName AS EmployeeLastName,
          e.Title AS EmployeeTitle, e.ReportsTo, m.FirstName AS ManagerFirstName,
          m.LastName AS ManagerLastName, m.Title AS ManagerTitle
        FROM v_customer c LEFT JOIN v_employee e ON c.SupportRepId = e.EmployeeId
        LEFT JOIN v_employee m ON e.ReportsTo = m.EmployeeId""",
    "full_copy_counts": _table_counts(""),
    "snapshot_latest": VIEWS + """
        SELECT InvoiceId, CustomerId, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS InvoiceDate,
          BillingCity, BillingState, CAST(Total AS DOUBLE) AS Total
        FROM v_invoice JOIN orders ON InvoiceId = o_orderkey""",
    "snapshot_roundtrip": _iso_dates(VIEWS + DAILY + "SELECT * FROM daily", "fecha"),
    "catalog_tables": _table_counts("dl_", twice=("Invoice",)),
    "customer_basic_features": VIEWS + f"""
        SELECT CustomerId, {BASIC} FROM v_bought GROUP BY CustomerId""",
    "customer_genre_mix": VIEWS + f"""
        SELECT CustomerId, {SHARES} FROM v_bought GROUP BY CustomerId""",
    "genre_pivot": VIEWS
    + "SELECT CustomerId, "
    + ", ".join(f"count(*) FILTER (genre = '{g}') AS {g}" for g in GENRES)
    + " FROM v_bought GROUP BY CustomerId",
    "customer_features": VIEWS + FEATURES + "SELECT * FROM features",
    "scaled_features": VIEWS + FEATURES + f"SELECT CustomerId, {SCALED} FROM features",
    "segmentation_checks": VIEWS + """
        SELECT unnest(['customers', 'far', 'profile', 'examples']) AS check_name,
               unnest([(SELECT count(DISTINCT CustomerId) FROM v_bought
                        WHERE CustomerId IN (SELECT CustomerId FROM v_customer)), 0, 0, 0]) AS value""",
    "silhouette_sweep_checks": VIEWS + f"""
        SELECT CAST(k AS INTEGER) AS asked, CAST(k AS INTEGER) AS k, {BUYERS} AS customers,
          0 AS far, false AS cheap, false AS unrated FROM range(2, 11) ks(k)""",
    "segmentation_run_checks": VIEWS + f"""
        SELECT unnest(['customers', 'clusters', 'profile', 'moved', 'missing']) AS check_name,
               unnest([{BUYERS}, 0, 0, 0, 0]) AS value""",
    "country_silhouettes": VIEWS + FEATURES + COUNTRY_SILHOUETTES,
    "catalog_search": VIEWS + """
        SELECT * REPLACE (CAST(UnitPrice AS DOUBLE) AS UnitPrice) FROM v_track
        WHERE v_track.Name ILIKE '%ring%' AND v_track.UnitPrice BETWEEN 900 AND 990
        ORDER BY TrackId LIMIT 50 OFFSET 10""",
    "catalog_filter": VIEWS + """
        SELECT * REPLACE (CAST(UnitPrice AS DOUBLE) AS UnitPrice) FROM v_track
        WHERE AlbumId = 'Brand#13' AND GenreId = 'STANDARD' AND TrackId > 20
        ORDER BY TrackId LIMIT 50""",
    "catalog_page": VIEWS + "SELECT * FROM v_album ORDER BY AlbumId LIMIT 10 OFFSET 5",
    "catalog_page_indexed": VIEWS + """
        SELECT * REPLACE (CAST(UnitPrice AS DOUBLE) AS UnitPrice) FROM v_track
        QUALIFY row_number() OVER (ORDER BY TrackId) - 1 - (SELECT count(*) // 2 FROM v_track)
            BETWEEN 0 AND 99""",
    "catalog_search_indexed": VIEWS + """
        SELECT * REPLACE (CAST(UnitPrice AS DOUBLE) AS UnitPrice) FROM v_track
        WHERE v_track.UnitPrice < 1000 ORDER BY TrackId LIMIT 20 OFFSET 20""",
    "point_lookup": VIEWS + """
        SELECT x.TrackId, t.TrackId IS NOT NULL AS found, t.Name,
               CAST(t.UnitPrice AS DOUBLE) AS UnitPrice, count(*) AS requests
        FROM v_item x LEFT JOIN v_track t ON x.TrackId = t.TrackId
        GROUP BY x.TrackId, t.TrackId, t.Name, t.UnitPrice""",
    "invoice_lookup_skipping": VIEWS + """
        , best AS (
          SELECT last(InvoiceId ORDER BY Total, InvoiceId) AS InvoiceId
          FROM v_invoice GROUP BY strftime(fecha, '%Y-%m')
          UNION ALL SELECT max(InvoiceId) + 1000000000 FROM v_invoice)
        SELECT b.InvoiceId, i.CustomerId, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS InvoiceDate,
          i.BillingCity, i.BillingState, CAST(i.Total AS DOUBLE) AS Total,
          i.InvoiceId IS NOT NULL AS found
        FROM best b LEFT JOIN v_invoice i ON b.InvoiceId = i.InvoiceId
        LEFT JOIN orders ON b.InvoiceId = o_orderkey""",
    "catalog_filter_skipping": VIEWS + """
        SELECT * REPLACE (CAST(UnitPrice AS DOUBLE) AS UnitPrice) FROM v_track
        WHERE AlbumId = 'Brand#13' AND GenreId = 'STANDARD'""",
    "checkout_validation": VIEWS + CHECKOUT + "SELECT CheckoutId, failed_rules FROM judged",
    "price_checkouts": VIEWS + CHECKOUT + """
        SELECT CheckoutId AS InvoiceId, CustomerId, BillingCity, Total, RepricedItems
        FROM reasoned WHERE reason IS NULL""",
    "checkout_lines": VIEWS + CHECKOUT + """
        SELECT f.CheckoutId AS InvoiceId, Seq, TrackId,
               CAST(catalog_price AS DOUBLE) AS UnitPrice, Quantity,
               UnitPrice <> catalog_price AS Repriced
        FROM item_facts f JOIN reasoned r ON f.CheckoutId = r.CheckoutId
        WHERE r.reason IS NULL""",
    "checkout_rejects": VIEWS + CHECKOUT + """
        SELECT CheckoutId, reason, failed_rules,
          CASE WHEN reason = 'track_not_found' THEN (
            SELECT min(TrackId) FROM item_facts f
            WHERE f.CheckoutId = reasoned.CheckoutId AND f.Seq = unknown_seq) END
          AS unknown_track
        FROM reasoned WHERE reason IS NOT NULL""",
    "new_customer_screening": VIEWS + """
        , candidates AS (
          SELECT c_custkey AS CandidateId,
            CASE WHEN c_custkey % 17 <> 0 THEN c_mktsegment END AS FirstName,
            CASE WHEN c_custkey % 19 = 0 THEN c_name || c_name ELSE c_name END AS LastName,
            CASE WHEN c_custkey % 3 = 0 THEN 'shared@mail.test'
                 WHEN c_custkey % 23 = 0 THEN 'no address'
                 WHEN c_custkey % 5 = 0 THEN 'new' || c_custkey || '@mail.test'
                 ELSE lower(replace(c_name, '#', '.')) || '@mail.test' END AS Email
          FROM customer),
        screened AS (
          SELECT *, concat_ws(',',
            CASE WHEN NOT coalesce(length(FirstName) BETWEEN 1 AND 40, false)
                 THEN 'FirstName' END,
            CASE WHEN NOT coalesce(length(LastName) BETWEEN 1 AND 20, false)
                 THEN 'LastName' END,
            CASE WHEN Email NOT LIKE '%@%' THEN 'Email' END) AS broken
          FROM candidates)
        SELECT CandidateId, CASE
          WHEN broken = '' AND (Email IN (SELECT Email FROM v_customer) OR EXISTS (
            SELECT 1 FROM screened o WHERE o.Email = s.Email AND o.broken = ''
            AND o.CandidateId < s.CandidateId)) THEN 'email_exists'
          ELSE broken END AS failed_rules
        FROM screened s""",
    "constraint_audit": _audit(),
    "invoice_documents": VIEWS + """
        , numbered AS (
          SELECT *, row_number() OVER (PARTITION BY InvoiceId
            ORDER BY InvoiceLineId, TrackId, UnitPrice, Quantity) - 1 AS n FROM v_line)
        SELECT i.InvoiceId, i.CustomerId,
          strftime(i.fecha, '%Y-%m-%d %H:%M:%S') AS InvoiceDate, i.BillingCity,
          CAST(i.Total AS DOUBLE) AS Total, CAST(coalesce(n // 3, 0) AS INTEGER) AS Part,
          CAST(count(InvoiceLineId) AS INTEGER) AS line_count,
          coalesce(string_agg(InvoiceLineId || ':' || TrackId || ':' || UnitPrice || ':'
            || Quantity, '|' ORDER BY n), '') AS Lines
        FROM v_invoice i LEFT JOIN numbered l ON i.InvoiceId = l.InvoiceId GROUP BY ALL""",
    "cart_merge": VIEWS + """
        SELECT CheckoutId, TrackId, min(Seq) AS Seq, CAST(sum(Quantity) AS BIGINT) AS Quantity,
               CAST((list(UnitPrice ORDER BY Seq, UnitPrice))[1] AS DOUBLE) AS UnitPrice
        FROM v_item GROUP BY CheckoutId, TrackId""",
    "cart_totals": VIEWS + """
        SELECT CheckoutId, round_even(CAST(sum(CASE WHEN CheckoutId % 11 = 0 THEN 0
                 ELSE UnitPrice * Quantity END) AS DOUBLE) * 100, 0) / 100 AS total,
               CAST(sum(Quantity) AS BIGINT) AS total_items
        FROM v_item GROUP BY CheckoutId""",
    "parse_price": VIEWS + _PRICE_TEXTS + "SELECT * FROM parsed",
    "format_price": VIEWS + _PRICE_TEXTS + """
        SELECT InvoiceLineId, text, '$' || printf('%.2f', price) AS price FROM parsed""",
    "format_duration": VIEWS + """
        , lengths AS (
          SELECT TrackId, CASE TrackId % 10 WHEN 0 THEN NULL WHEN 1 THEN 0
            WHEN 2 THEN -Milliseconds WHEN 3 THEN Milliseconds * 97
            ELSE Milliseconds END AS milliseconds FROM v_track)
        SELECT TrackId, milliseconds, CASE WHEN milliseconds > 0
          THEN (milliseconds // 60000) || ':'
               || lpad(CAST(milliseconds % 60000 // 1000 AS VARCHAR), 2, '0')
          ELSE '0:00' END AS duration
        FROM lengths""",
}

# Other ways to the same results.
ORACLE |= {
    "sales_per_day_bucketed": ORACLE["sales_per_day"],
    "sales_by_month_merged": ORACLE["sales_by_month"],
    "sales_by_weekday_merged": ORACLE["sales_by_weekday"],
    "weekend_comparison_merged": ORACLE["weekend_comparison"],
}
