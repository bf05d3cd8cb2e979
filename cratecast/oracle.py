"""DuckDB oracle SQL for the registered queries.

Every statement is written independently of the Spark code: the star-schema
to domain mapping, then the plan's stages, as one chain of CTEs over the
pre-registered views (orders, lineitem, customer, part, supplier, nation,
events). Group statistics use plain SQL windows here, a deliberately
different formulation from the Spark operators, so that agreement means
something. Only CTEs a final SELECT references are evaluated.
"""

from __future__ import annotations

import datetime as dt

from .params import CHANNELS, PlanParams, fixture_params
from .sources.fixtures import CHILD_SUFFIX, FIXTURE_CRATES, SEGMENT_CHANNEL


def _lst(xs) -> str:
    return ", ".join("'" + str(x).replace("'", "''") + "'" for x in xs)


def _seg_case(col: str) -> str:
    arms = " ".join(f"WHEN {col} = '{s}' THEN '{c}'" for s, c in SEGMENT_CHANNEL)
    return f"CASE {arms} END"


def _pad(expr: str, n: int) -> str:
    return f"lpad(CAST({expr} AS VARCHAR), {n}, '0')"


def fixture_ctes() -> list[tuple[str, str]]:
    crates = ", ".join(f"({m}, CAST({u} AS DOUBLE))" for m, u in FIXTURE_CRATES)
    chans = ", ".join("(" + _lst([i]) + ", " + _lst([n]) + ")" for i, n in CHANNELS)
    return [
        ("routes", """SELECT n_nationkey, 'D00' || CAST(n_regionkey + 1 AS VARCHAR) AS UNE,
              'D00' || CAST(n_regionkey + 1 AS VARCHAR) || 'R' || CAST(n_nationkey AS VARCHAR) AS Ruta FROM nation"""),
        ("client_route", """SELECT c.c_custkey, c.c_mktsegment, r.UNE, r.Ruta
              FROM customer c JOIN routes r ON c.c_nationkey = r.n_nationkey"""),
        ("product_codes", f"""SELECT p_type, {_pad('dense_rank() OVER (ORDER BY p_type)', 3)} AS ProductoClave
              FROM (SELECT DISTINCT p_type FROM part) t"""),
        ("sale_header", f"""SELECT {_pad('o.o_orderkey', 12)} AS TransProdID, CAST(o.o_custkey AS VARCHAR) AS ClienteClave,
              cr.Ruta AS MUsuarioID, CAST(o.o_orderdate AS DATE) AS DiaClave, 1 AS Tipo, 1 AS TipoFaseIntSal,
              CASE WHEN o.o_orderstatus = 'P' THEN 0 ELSE 1 END AS TipoFase, 2 AS TipoMovimiento
              FROM orders o JOIN client_route cr ON o.o_custkey = cr.c_custkey"""),
        ("sale_line", f"""SELECT {_pad('l.l_orderkey', 12)} AS TransProdID,
              concat_ws('-', {_pad('l.l_linenumber', 3)}, {_pad('l.l_partkey', 12)}, {_pad('l.l_suppkey', 12)},
                        {_pad('CAST(l.l_quantity AS BIGINT)', 6)}) AS TransProdDetalleID,
              pc.ProductoClave, CAST(1 + l.l_linenumber % 2 AS INTEGER) AS TipoUnidad, l.l_quantity AS Cantidad,
              p.p_retailprice AS Precio, l.l_extendedprice AS Total,
              l.l_shipdate AS MFechaHora, sr.Ruta AS MUsuarioID
              FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN product_codes pc ON p.p_type = pc.p_type
              JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN routes sr ON s.s_nationkey = sr.n_nationkey"""),
        ("warehouse", "SELECT Ruta AS AlmacenID, UNE AS AlmacenPadreid FROM routes"),
        ("client_channel", f"""SELECT CAST(c_custkey AS VARCHAR) AS ClienteClave, {_seg_case('c_mktsegment')} AS EsquemaID FROM customer
              UNION ALL
              SELECT CAST(c_custkey AS VARCHAR), {_seg_case('c_mktsegment')} || '{CHILD_SUFFIX}' FROM customer WHERE c_custkey % 10 = 0"""),
        ("product_unit", """SELECT pc.ProductoClave, u.t AS PRUTipoUnidad, CAST(CAST(pc.ProductoClave AS INTEGER) * u.t AS DOUBLE) AS KgLts
              FROM product_codes pc, (VALUES (1), (2)) u(t)"""),
        ("product_detail", """SELECT pc.ProductoClave, u.t AS PRUTipoUnidad, CAST(u.t AS DOUBLE) AS Factor
              FROM product_codes pc, (VALUES (1), (2)) u(t)"""),
        ("client", """SELECT CAST(c_custkey AS VARCHAR) AS ClienteClave,
              CASE WHEN c_custkey % 20 = 19 THEN 0 ELSE 1 END AS TipoEstado, UNE AS AlmacenID FROM client_route"""),
        ("sequence", """SELECT CAST(o.o_custkey AS VARCHAR) AS ClienteClave,
              CASE WHEN o.o_custkey % 50 = 0 AND o.o_orderpriority = '5-LOW' THEN NULL ELSE o.o_orderpriority END AS FrecuenciaClave,
              cr.Ruta AS RUTClave
              FROM (SELECT DISTINCT o_custkey, o_orderpriority FROM orders) o JOIN client_route cr ON o.o_custkey = cr.c_custkey"""),
        ("visit", """SELECT CAST(e.user_id AS VARCHAR) AS ClienteClave, e.DiaClave, e.FechaHoraInicial, e.FechaHoraFinal, cr.Ruta AS RUTClave
              FROM (SELECT user_id, CAST(ts AS DATE) AS DiaClave, min(ts) AS FechaHoraInicial, max(ts) AS FechaHoraFinal
                    FROM events GROUP BY 1, 2) e JOIN client_route cr ON e.user_id = cr.c_custkey"""),
        ("agenda", """SELECT a.DiaClave, cr.Ruta AS VendedorId, a.o_orderpriority AS FrecuenciaClave, cr.Ruta AS RUTClave,
              CAST(a.o_custkey AS VARCHAR) AS ClienteClave, cr.UNE AS ClaveCEDI
              FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS DiaClave, o_custkey, o_orderpriority FROM orders) a
              JOIN client_route cr ON a.o_custkey = cr.c_custkey"""),
        ("dim_crates", f"SELECT * FROM (VALUES {crates}) v(Material, Unidad_de_Carga)"),
        ("dim_channels", f"SELECT * FROM (VALUES {chans}) v(Id, Nombre)"),
    ]


def _z(col: str, part: str, out: str, single: float = 10.0) -> str:
    w = f"(PARTITION BY {part})"
    return (
        f"CASE WHEN count(*) OVER {w} <= 1 THEN {single!r} "
        f"WHEN stddev_samp({col}) OVER {w} = 0 THEN 0.0 "
        f"ELSE ({col} - avg({col}) OVER {w}) / stddev_samp({col}) OVER {w} END AS {out}"
    )


def plan_ctes(p: PlanParams) -> list[tuple[str, str]]:
    units, chans = _lst(p.units), _lst(p.channels)
    dates = f"DATE '{p.start.isoformat()}' AND DATE '{p.end.isoformat()}'"
    status = (
        f"h.Tipo = {p.tipo} AND h.TipoFaseIntSal = {p.tipo_fase_int_sal} AND h.TipoFase <> 0 "
        f"AND h.TipoMovimiento = {p.tipo_movimiento}"
    )
    lo, hi = p.z_lo, p.z_hi
    return [
        ("channel_codes", f"SELECT * FROM client_channel WHERE length(rtrim(EsquemaID)) = 3 AND EsquemaID IN ({chans})"),
        ("sales_detail", f"""SELECT h.DiaClave AS Fecha, w.AlmacenPadreid AS UNE, w.AlmacenID AS Ruta, h.ClienteClave, cc.EsquemaID,
              l.ProductoClave, round(l.Cantidad * pu.KgLts, 3) AS KgLts_Total, h.TransProdID, l.TransProdDetalleID
              FROM sale_header h JOIN sale_line l ON h.TransProdID = l.TransProdID
              JOIN warehouse w ON h.MUsuarioID = w.AlmacenID
              JOIN channel_codes cc ON h.ClienteClave = cc.ClienteClave
              JOIN product_unit pu ON l.ProductoClave = pu.ProductoClave AND l.TipoUnidad = pu.PRUTipoUnidad
              WHERE {status} AND h.DiaClave BETWEEN {dates} AND w.AlmacenPadreid IN ({units})"""),
        ("sales", """SELECT *, CAST(month(Fecha) AS INTEGER) AS Mes, CAST(year(Fecha) AS INTEGER) AS "Year",
              CAST(isodow(Fecha) - 1 AS INTEGER) AS Dia, CAST(weekofyear(Fecha) AS INTEGER) AS Semana FROM sales_detail"""),
        ("day_totals", """SELECT ClienteClave, Fecha, sum(KgLts_Total) AS Venta_Total_dia, count(*) AS n_lines
              FROM sales GROUP BY ClienteClave, Fecha"""),
        ("sales_dt", """SELECT s.*, d.Venta_Total_dia FROM sales s
              JOIN day_totals d ON s.ClienteClave = d.ClienteClave AND s.Fecha = d.Fecha"""),
        ("p95", f"SELECT quantile_cont(Venta_Total_dia, {p.p_cut}) AS q FROM sales_dt"),
        ("p_sales", "SELECT s.* FROM sales_dt s, p95 WHERE s.Venta_Total_dia < p95.q"),
        ("zc", f"SELECT *, {_z('Venta_Total_dia', 'ClienteClave', 'Valor_Z_general')} FROM p_sales"),
        ("z_client", f"SELECT * FROM zc WHERE Valor_Z_general > {lo} AND Valor_Z_general <= {hi}"),
        ("zp", f"SELECT *, {_z('KgLts_Total', 'ClienteClave, ProductoClave', 'Valor_Z_detalle')} FROM z_client"),
        ("clean", f"SELECT * FROM zp WHERE Valor_Z_detalle > {lo} AND Valor_Z_detalle <= {hi}"),
    ] + dataset_ctes(p) + curve_ctes(p) + mix_ctes(p) + load_ctes(p)


def _rn(src: str, part: str, order: str) -> str:
    return f"SELECT * EXCLUDE (rn__) FROM (SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY {order}) AS rn__ FROM {src}) t WHERE rn__ = 1"


def dataset_ctes(p: PlanParams) -> list[tuple[str, str]]:
    units, chans = _lst(p.units), _lst(p.channels)
    b = ["Bajo", "Medio Bajo", "Medio Alto", "Alto"]
    return [
        ("seq", f"""SELECT c.ClienteClave, s.FrecuenciaClave, ce.EsquemaID FROM client c
              LEFT JOIN sequence s ON c.ClienteClave = s.ClienteClave LEFT JOIN client_channel ce ON c.ClienteClave = ce.ClienteClave
              WHERE c.TipoEstado = 1 AND c.AlmacenID IN ({units}) AND ce.EsquemaID IN ({chans})"""),
        ("nweeks", "SELECT CAST(floor(datediff('day', min(Fecha), max(Fecha)) / 7) AS INTEGER) AS n FROM sales"),
        ("weekly_visits", """SELECT v.ClienteClave, v.Visitas_Semanales, v.Visitas_Semanales * CAST(w.n AS BIGINT) AS Visitas_Totales
              FROM (SELECT ClienteClave, CAST(count(DISTINCT FrecuenciaClave)
                          + max(CASE WHEN FrecuenciaClave IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS Visitas_Semanales
                    FROM seq GROUP BY ClienteClave) v, nweeks w"""),
        ("codes", """SELECT FrecuenciaClave, CAST(row_number() OVER (ORDER BY FrecuenciaClave DESC) - 1 AS INTEGER) AS Dia
              FROM (SELECT DISTINCT FrecuenciaClave FROM seq WHERE FrecuenciaClave IS NOT NULL) c"""),
        ("plan_days", "SELECT s.ClienteClave, s.FrecuenciaClave, s.EsquemaID, c.Dia FROM seq s JOIN codes c ON s.FrecuenciaClave = c.FrecuenciaClave"),
        ("visit_plan", """SELECT d.ClienteClave, d.EsquemaID, d.Dia, v.Visitas_Semanales FROM plan_days d
              LEFT JOIN (SELECT ClienteClave, CAST(count(DISTINCT FrecuenciaClave) AS BIGINT) AS Visitas_Semanales
                         FROM plan_days GROUP BY ClienteClave) v ON d.ClienteClave = v.ClienteClave"""),
        ("wd_stats", """SELECT ClienteClave, Dia, avg(Venta_Total_dia) AS Venta_media_por_dia, median(Venta_Total_dia) AS Venta_mediana_por_dia
              FROM (SELECT DISTINCT ClienteClave, Fecha, Dia, Venta_Total_dia FROM p_sales) d GROUP BY ClienteClave, Dia"""),
        ("dprod", """SELECT c.*, w.Venta_media_por_dia, w.Venta_mediana_por_dia, v.Visitas_Semanales FROM clean c
              LEFT JOIN wd_stats w ON c.ClienteClave = w.ClienteClave AND c.Dia = w.Dia
              JOIN weekly_visits v ON c.ClienteClave = v.ClienteClave"""),
        ("daily", _rn("dprod", "ClienteClave, Semana, Dia", "Fecha, TransProdID, TransProdDetalleID")),
        ("quart", """SELECT quantile_cont(Venta_media_por_dia, 0.25) AS q1, quantile_cont(Venta_media_por_dia, 0.5) AS q2,
              quantile_cont(Venta_media_por_dia, 0.75) AS q3 FROM daily"""),
        ("banded", f"""SELECT d.*, CASE WHEN d.Venta_Total_dia <= q.q1 THEN '{b[0]}' WHEN d.Venta_Total_dia <= q.q2 THEN '{b[1]}'
              WHEN d.Venta_Total_dia <= q.q3 THEN '{b[2]}' WHEN d.Venta_Total_dia IS NOT NULL THEN '{b[3]}' END AS Categoria,
              q.q1, q.q2, q.q3 FROM daily d, quart q"""),
        ("band_mode", """SELECT ClienteClave, Dia, Categoria FROM (SELECT *, row_number() OVER (PARTITION BY ClienteClave, Dia
              ORDER BY n DESC, Categoria) AS rn FROM (SELECT ClienteClave, Dia, Categoria, count(*) AS n FROM banded
              WHERE Categoria IS NOT NULL GROUP BY ClienteClave, Dia, Categoria) t) u WHERE rn = 1"""),
        ("pred_in", """SELECT m.ClienteClave, m.Dia, m.Venta_media_por_dia, b.Categoria
              FROM (SELECT DISTINCT ClienteClave, Dia, Venta_media_por_dia FROM banded) m
              JOIN band_mode b ON m.ClienteClave = b.ClienteClave AND m.Dia = b.Dia"""),
        ("planned", """SELECT p.ClienteClave, p.EsquemaID, p.Dia, p.Visitas_Semanales, i.Venta_media_por_dia, i.Categoria
              FROM visit_plan p LEFT JOIN pred_in i ON p.ClienteClave = i.ClienteClave AND p.Dia = i.Dia"""),
        ("cold", "SELECT ClienteClave, EsquemaID, Visitas_Semanales FROM (" + _rn("(SELECT * FROM planned WHERE Categoria IS NULL)", "ClienteClave", "EsquemaID, Visitas_Semanales") + ") c"),
        ("warm", f"""SELECT p.*, {p.forecast_month} AS Mes, {p.forecast_week} AS Semana FROM planned p
              WHERE p.ClienteClave IS NOT NULL AND p.EsquemaID IS NOT NULL AND p.Dia IS NOT NULL AND p.Visitas_Semanales IS NOT NULL
              AND p.Venta_media_por_dia IS NOT NULL AND p.Categoria IS NOT NULL
              AND p.ClienteClave NOT IN (SELECT ClienteClave FROM cold)"""),
        ("client_attrs", "SELECT ClienteClave, Ruta, UNE FROM (" + _rn("sales", "ClienteClave", "Fecha, TransProdID, TransProdDetalleID") + ") a"),
    ]


def curve_ctes(p: PlanParams) -> list[tuple[str, str]]:
    k = "PARTITION BY EsquemaID, Visitas_Semanales ORDER BY Semana"
    pre = f"({k} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    fol = f"({k} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    return [
        ("wrange", "SELECT min(Semana) AS w0, max(Semana) AS w1 FROM sales"),
        ("cgrid0", """SELECT c.EsquemaID, c.Visitas_Semanales, CAST(unnest(generate_series(r.w0, r.w1)) AS INTEGER) AS Semana
              FROM (SELECT DISTINCT EsquemaID, Visitas_Semanales FROM daily) c, wrange r"""),
        ("cmean", "SELECT EsquemaID, Semana, Visitas_Semanales, avg(Venta_Total_dia) AS Venta_Total_dia FROM daily GROUP BY 1, 2, 3"),
        ("curve_grid", """SELECT g.EsquemaID, g.Visitas_Semanales, g.Semana, m.Venta_Total_dia FROM cgrid0 g
              LEFT JOIN cmean m ON g.EsquemaID = m.EsquemaID AND g.Semana = m.Semana AND g.Visitas_Semanales = m.Visitas_Semanales"""),
        ("curve_filled", """SELECT EsquemaID, Visitas_Semanales, Semana,
              coalesce(Venta_Total_dia, avg(Venta_Total_dia) OVER (PARTITION BY EsquemaID)) AS Venta_Total_dia FROM curve_grid"""),
        ("cz", f"SELECT *, {_z('Venta_Total_dia', 'EsquemaID, Visitas_Semanales', 'Valor_Z')} FROM curve_filled"),
        ("cnull", f"""SELECT EsquemaID, Visitas_Semanales, Semana,
              CASE WHEN Valor_Z >= {p.z_curve_null} THEN NULL ELSE Venta_Total_dia END AS v FROM cz"""),
        ("cint", f"""SELECT *, last_value(v IGNORE NULLS) OVER {pre} AS pv,
              last_value(CASE WHEN v IS NOT NULL THEN Semana END IGNORE NULLS) OVER {pre} AS pp,
              first_value(v IGNORE NULLS) OVER {fol} AS nv,
              first_value(CASE WHEN v IS NOT NULL THEN Semana END IGNORE NULLS) OVER {fol} AS np_ FROM cnull"""),
        ("curves0", """SELECT EsquemaID, Visitas_Semanales, Semana, CASE WHEN v IS NOT NULL THEN v
              WHEN pv IS NOT NULL AND nv IS NOT NULL THEN pv + (nv - pv) * (Semana - pp) / (np_ - pp)
              WHEN pv IS NOT NULL THEN pv ELSE nv END AS Venta_Total_dia FROM cint"""),
        ("curves", "SELECT *, round_even(round(Venta_Total_dia, 9) * CAST(1000 AS DOUBLE), 0) / CAST(1000 AS DOUBLE) AS prediccion FROM curves0"),
        ("curve_forecast", f"""SELECT d.ClienteClave, c.EsquemaID, cv.Semana, d.Dia, c.Visitas_Semanales,
              cv.prediccion / c.Visitas_Semanales AS prediccion
              FROM plan_days d JOIN cold c ON d.ClienteClave = c.ClienteClave
              JOIN curves cv ON c.EsquemaID = cv.EsquemaID AND c.Visitas_Semanales = cv.Visitas_Semanales AND cv.Semana = {p.forecast_week}"""),
        ("fc", f"""SELECT ClienteClave, EsquemaID, Semana, Dia, Visitas_Semanales, Venta_media_por_dia * {p.uplift!r} AS prediccion FROM warm
              UNION ALL
              SELECT ClienteClave, EsquemaID, Semana, Dia, Visitas_Semanales, prediccion * {p.uplift!r} FROM curve_forecast"""),
        ("weekly", """SELECT f.ClienteClave, a.UNE, a.Ruta, f.EsquemaID, f.Semana, f.Visitas_Semanales,
              coalesce(sum(f.prediccion), 0.0) AS prediccion
              FROM fc f JOIN client_attrs a ON f.ClienteClave = a.ClienteClave
              WHERE f.ClienteClave IS NOT NULL AND a.UNE IS NOT NULL AND a.Ruta IS NOT NULL AND f.EsquemaID IS NOT NULL
                AND f.Semana IS NOT NULL AND f.Visitas_Semanales IS NOT NULL
              GROUP BY f.ClienteClave, a.UNE, a.Ruta, f.EsquemaID, f.Semana, f.Visitas_Semanales"""),
    ]


def _days(p: PlanParams) -> list[str]:
    return [n for _, n in p.days]


def mix_ctes(p: PlanParams) -> list[tuple[str, str]]:
    days = _days(p)
    dsum = ", ".join(f"coalesce(sum(CASE WHEN Dia = {d} THEN KgLts_Total END), 0.0) AS {n}" for d, n in p.days)
    ddiv = ", ".join(f"{n} / NULLIF(kg, 0) AS {n}" for n in days)
    dl = ", ".join(days)
    hdl = ", ".join(f"h.{n}" for n in days)
    w = p.blend_weight
    return [
        ("day_mix", f"""SELECT ClienteClave, ProductoClave, {ddiv},
              kg * 100.0 / NULLIF(sum(kg) OVER (PARTITION BY ClienteClave), 0) AS Porcentaje
              FROM (SELECT ClienteClave, ProductoClave, sum(KgLts_Total) AS kg, {dsum} FROM p_sales GROUP BY 1, 2) g"""),
        ("mz", f"SELECT *, {_z('KgLts_Total', 'UNE, ClienteClave', 'Valor_Z')} FROM p_sales"),
        ("mix_clean", f"SELECT * FROM mz WHERE Valor_Z <= {p.z_mix}"),
        ("mix_median", """SELECT UNE, ClienteClave, ProductoClave, median(w) AS KgLts_Total FROM (SELECT UNE, ClienteClave, "Year", Semana,
              ProductoClave, sum(KgLts_Total) AS w FROM mix_clean GROUP BY 1, 2, 3, 4, 5) t GROUP BY 1, 2, 3"""),
        ("mix_long", """SELECT UNE, ClienteClave, ProductoClave,
              KgLts_Total * 100.0 / NULLIF(sum(KgLts_Total) OVER (PARTITION BY UNE, ClienteClave), 0) AS Porcentaje FROM mix_median"""),
        ("assign", """SELECT m.UNE, m.ClienteClave, ch.Cluster FROM (SELECT DISTINCT UNE, ClienteClave FROM mix_long) m
              JOIN (SELECT ClienteClave, min(EsquemaID) AS Cluster FROM sales GROUP BY ClienteClave) ch ON m.ClienteClave = ch.ClienteClave"""),
        ("centres", """SELECT mb.UNE, mb.Cluster, u.ProductoClave, coalesce(cs.s, 0.0) / mb.n_members AS Porcentaje_kmeans
              FROM (SELECT UNE, Cluster, count(*) AS n_members FROM assign GROUP BY 1, 2) mb
              JOIN (SELECT DISTINCT UNE, ProductoClave FROM mix_long) u ON mb.UNE = u.UNE
              LEFT JOIN (SELECT a.UNE, a.Cluster, m.ProductoClave, sum(m.Porcentaje) AS s FROM mix_long m
                         JOIN assign a ON m.UNE = a.UNE AND m.ClienteClave = a.ClienteClave GROUP BY 1, 2, 3) cs
                ON cs.UNE = mb.UNE AND cs.Cluster = mb.Cluster AND cs.ProductoClave = u.ProductoClave"""),
        ("cluster_mix", """SELECT a.UNE, a.ClienteClave, a.Cluster, c.ProductoClave, c.Porcentaje_kmeans FROM assign a
              JOIN centres c ON a.UNE = c.UNE AND a.Cluster = c.Cluster"""),
        ("blended", f"""SELECT h.ClienteClave, h.ProductoClave, {hdl},
              {1.0 - w!r} * h.Porcentaje + {w!r} * k.Porcentaje_kmeans AS Porcentaje
              FROM day_mix h JOIN cluster_mix k ON h.ClienteClave = k.ClienteClave AND h.ProductoClave = k.ProductoClave"""),
        ("unblended", f"""SELECT ClienteClave, ProductoClave, {dl}, Porcentaje FROM day_mix
              WHERE ClienteClave NOT IN (SELECT ClienteClave FROM blended)"""),
        ("allmix", f"SELECT ClienteClave, ProductoClave, {dl}, Porcentaje FROM blended UNION ALL SELECT * FROM unblended"),
        ("rs", """SELECT *, sum(Porcentaje) OVER (PARTITION BY ClienteClave ORDER BY Porcentaje DESC, ProductoClave
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS Agg FROM allmix"""),
        ("kept0", f"SELECT * EXCLUDE (Agg) FROM rs WHERE round(Agg, {p.share_decimals}) < {p.share_cut!r}"),
        ("kept", f"""SELECT k.ClienteClave, k.ProductoClave, {', '.join('k.' + n for n in days)},
              (k.Porcentaje * 100.0 / t.Total) / 100.0 AS Porcentaje FROM kept0 k
              JOIN (SELECT ClienteClave, sum(Porcentaje) AS Total FROM kept0 GROUP BY 1) t ON k.ClienteClave = t.ClienteClave"""),
        ("topone", f"""SELECT ClienteClave, ProductoClave, {dl}, CAST(1.0 AS DOUBLE) AS Porcentaje FROM ("""
              + _rn("(SELECT * FROM allmix WHERE ClienteClave NOT IN (SELECT ClienteClave FROM kept0))", "ClienteClave", "Porcentaje DESC, ProductoClave")
              + ") t"),
        ("blend", f"""SELECT * FROM (SELECT * FROM kept UNION ALL SELECT * FROM topone) b
              WHERE ClienteClave IN (SELECT ClienteClave FROM fc)"""),
    ]


def load_ctes(p: PlanParams) -> list[tuple[str, str]]:
    days = _days(p)
    dv = ", ".join(f"b.{n} * (w.prediccion * b.Porcentaje) AS {n}" for n in days)
    melt = " UNION ALL ".join(
        f"SELECT UNE, Ruta, ClienteClave, ProductoClave, '{n}' AS Dia, {n} AS Total FROM day_volume" for n in days
    )
    t = p.crate_round_threshold
    return [
        ("day_volume", f"""SELECT w.ClienteClave, w.UNE, w.Ruta, w.EsquemaID, w.Semana, w.Visitas_Semanales, b.ProductoClave, {dv},
              w.prediccion * b.Porcentaje AS Porcentaje FROM weekly w LEFT JOIN blend b ON w.ClienteClave = b.ClienteClave"""),
        ("punits", """SELECT pd.ProductoClave, pd.PRUTipoUnidad, pd.Factor, pu.KgLts FROM product_detail pd
              JOIN product_unit pu ON pd.ProductoClave = pu.ProductoClave AND pd.PRUTipoUnidad = pu.PRUTipoUnidad"""),
        ("unit_min", "SELECT ProductoClave, KgLts FROM (" + _rn("punits", "ProductoClave", "PRUTipoUnidad") + ") u"),
        ("melt", melt),
        ("pieces0", f"""SELECT m.UNE, m.Ruta, m.ClienteClave, m.ProductoClave, m.Dia,
              CAST(ceil(round_even(round(m.Total / NULLIF(u.KgLts, 0), {p.share_decimals}), 0)) AS DOUBLE) AS Piezas, u.KgLts
              FROM melt m JOIN unit_min u ON m.ProductoClave = u.ProductoClave"""),
        ("pieces", "SELECT UNE, Ruta, ClienteClave, ProductoClave, Dia, Piezas, Piezas * KgLts AS Litros FROM pieces0 WHERE Piezas > 0"),
        ("rl1", """SELECT r.*, u.KgLts, TRY_CAST(trim(r.ProductoClave) AS INTEGER) AS Material
              FROM (SELECT UNE, Ruta, ProductoClave, Dia, sum(Piezas) AS Piezas, sum(Litros) AS Litros FROM pieces GROUP BY 1, 2, 3, 4) r
              JOIN unit_min u ON r.ProductoClave = u.ProductoClave WHERE r.Piezas > 0"""),
        ("crates_x", """SELECT r.*, c.Unidad_de_Carga, r.Piezas / NULLIF(c.Unidad_de_Carga, 0) AS x
              FROM rl1 r JOIN dim_crates c ON r.Material = c.Material"""),
        ("crate_round", f"SELECT *, CASE WHEN x - floor(x) >= {t!r} THEN ceil(x) ELSE floor(x) END AS Rejas FROM crates_x"),
        ("route_load", """SELECT UNE, Ruta, Material, Dia, Piezas, Litros, Rejas, Rejas * Unidad_de_Carga AS Piezas_en_rejas,
              KgLts * (Rejas * Unidad_de_Carga) AS Litros_en_rejas FROM crate_round WHERE KgLts * (Rejas * Unidad_de_Carga) > 0"""),
    ]


def with_chain(select: str, p: PlanParams | None = None) -> str:
    p = p or fixture_params()
    ctes = fixture_ctes() + plan_ctes(p)
    body = ",\n".join(f"{n} AS (\n{sql}\n)" for n, sql in ctes)
    return f"WITH {body}\n{select}"


def r6(col: str, alias: str | None = None) -> str:
    """Half-even at 6 decimals on the binary value, as ``registry.rnd``."""
    return f"round_even(({col}) * CAST(1000000 AS DOUBLE), 0) / CAST(1000000 AS DOUBLE) AS {alias or col}"


# -- per-query statements ----------------------------------------------------------------

def _dbl(cols: list[str]) -> str:
    return ", ".join(r6(c) for c in cols)


def _queries(p: PlanParams) -> dict[str, str]:
    units, chans = _lst(p.units), _lst(p.channels)
    dates = f"DATE '{p.start.isoformat()}' AND DATE '{p.end.isoformat()}'"
    sales_cols = "Fecha, UNE, Ruta, ClienteClave, EsquemaID, ProductoClave, TransProdID, TransProdDetalleID, Mes, \"Year\", Dia, Semana"
    q: dict[str, str] = {}
    q["sales_detail"] = """SELECT Fecha, UNE, Ruta, ClienteClave, EsquemaID, ProductoClave, round_even((KgLts_Total) * CAST(1000000 AS DOUBLE), 0) / CAST(1000000 AS DOUBLE) AS KgLts_Total,
        TransProdID, TransProdDetalleID FROM sales_detail"""
    q["channel_codes"] = """SELECT cc.ClienteClave, cc.EsquemaID, d.Nombre FROM channel_codes cc JOIN dim_channels d ON cc.EsquemaID = d.Id"""
    q["visit_sequence"] = f"""SELECT c.ClienteClave, s.FrecuenciaClave, ce.EsquemaID FROM client c
        LEFT JOIN sequence s ON c.ClienteClave = s.ClienteClave LEFT JOIN client_channel ce ON c.ClienteClave = ce.ClienteClave
        WHERE c.TipoEstado = 1 AND c.AlmacenID IN ({units}) AND ce.EsquemaID IN ({chans})"""
    q["visit_log"] = f"""SELECT v.ClienteClave, v.DiaClave, v.FechaHoraInicial, v.FechaHoraFinal FROM visit v
        JOIN client_channel ce ON v.ClienteClave = ce.ClienteClave
        WHERE substring(v.RUTClave, 1, 4) IN ({units}) AND v.DiaClave BETWEEN {dates} AND ce.EsquemaID IN ({chans})"""
    q["product_units"] = """SELECT pd.ProductoClave, pd.PRUTipoUnidad, pd.Factor, pu.KgLts FROM product_detail pd
        JOIN product_unit pu ON pd.ProductoClave = pu.ProductoClave AND pd.PRUTipoUnidad = pu.PRUTipoUnidad"""
    q["active_routes"] = f"""SELECT DISTINCT d.AlmacenID, CAST(d.AlmacenID AS VARCHAR) AS ID FROM sequence c
        JOIN warehouse d ON c.RUTClave = d.AlmacenID WHERE d.AlmacenPadreid IN ({units})"""
    q["sales_history"] = f"""SELECT l.TransProdID, l.TransProdDetalleID, h.ClienteClave, ce.EsquemaID, l.ProductoClave, l.TipoUnidad,
        round_even((l.Cantidad) * CAST(1000000 AS DOUBLE), 0) / CAST(1000000 AS DOUBLE) AS Cantidad, round_even((l.Precio) * CAST(1000000 AS DOUBLE), 0) / CAST(1000000 AS DOUBLE) AS Precio, round_even((l.Total) * CAST(1000000 AS DOUBLE), 0) / CAST(1000000 AS DOUBLE) AS Total, l.MFechaHora, l.MUsuarioID,
        a.AlmacenPadreid AS AlmacenPadreId, h.Tipo, h.TipoFaseIntSal, h.TipoFase, h.TipoMovimiento
        FROM sale_line l JOIN sale_header h ON l.TransProdID = h.TransProdID JOIN warehouse a ON l.MUsuarioID = a.AlmacenID
        JOIN client_channel ce ON h.ClienteClave = ce.ClienteClave
        WHERE h.Tipo = {p.tipo} AND h.TipoFaseIntSal = {p.tipo_fase_int_sal} AND h.TipoFase <> 0 AND h.TipoMovimiento = {p.tipo_movimiento}
        AND CAST(l.MFechaHora AS DATE) BETWEEN {dates} AND a.AlmacenPadreid IN ({units}) AND ce.EsquemaID IN ({chans})"""
    q["unit_litres"] = "SELECT ProductoClave, PRUTipoUnidad, KgLts FROM product_unit"
    q["agenda"] = f"""SELECT DiaClave, VendedorId, FrecuenciaClave, RUTClave, ClienteClave, ClaveCEDI FROM agenda
        WHERE ClaveCEDI IN ({units}) AND DiaClave BETWEEN {dates}"""
    q["preview"] = "SELECT ClienteClave, EsquemaID FROM client_channel ORDER BY ClienteClave, EsquemaID LIMIT 100"
    q["calendar"] = 'SELECT DISTINCT Fecha, Mes, "Year", Dia, Semana FROM sales'
    q["day_totals"] = "SELECT ClienteClave, Fecha, round_even((Venta_Total_dia) * CAST(1000000 AS DOUBLE), 0) / CAST(1000000 AS DOUBLE) AS Venta_Total_dia, n_lines FROM day_totals"
    q["p95_sales"] = f"""SELECT {sales_cols}, {_dbl(['KgLts_Total', 'Venta_Total_dia'])}, round_even((p95.q) * CAST(1000000 AS DOUBLE), 0) / CAST(1000000 AS DOUBLE) AS p_value
        FROM p_sales, p95"""
    q["zscore_client"] = f"""SELECT DISTINCT ClienteClave, Fecha, {_dbl(['Venta_Total_dia', 'Valor_Z_general'])} FROM zc"""
    q["zscore_merged"] = q["zscore_client"]
    q["clean_sales"] = f"""SELECT {sales_cols}, {_dbl(['KgLts_Total', 'Venta_Total_dia', 'Valor_Z_general', 'Valor_Z_detalle'])}
        FROM clean"""
    q["retention"] = f"""SELECT n_sales, n_p, n_z_client, n_clean,
        {r6('round_even(round(n_z_client * 100.0 / n_p, 9) * CAST(100 AS DOUBLE), 0) / CAST(100 AS DOUBLE)', 'pct_z_client')},
        {r6('round_even(round(n_clean * 100.0 / n_p, 9) * CAST(100 AS DOUBLE), 0) / CAST(100 AS DOUBLE)', 'pct_clean')},
        {r6('round_even(round(100.0 - n_clean * 100.0 / n_sales, 9) * CAST(100 AS DOUBLE), 0) / CAST(100 AS DOUBLE)', 'pct_removed')}
        FROM (SELECT (SELECT count(*) FROM sales) AS n_sales, (SELECT count(*) FROM p_sales) AS n_p,
                     (SELECT count(*) FROM z_client) AS n_z_client, (SELECT count(*) FROM clean) AS n_clean) c"""
    q["visit_durations"] = f"""WITH v AS (
          SELECT vl.ClienteClave, vl.DiaClave,
                 CASE WHEN date_diff('microsecond', vl.FechaHoraInicial, vl.FechaHoraFinal) / 1000000.0 <= 0 THEN 0.0
                      ELSE date_diff('microsecond', vl.FechaHoraInicial, vl.FechaHoraFinal) / 1000000.0 END AS Visita_seg,
                 CAST(month(vl.DiaClave) AS INTEGER) AS Mes, CAST(year(vl.DiaClave) AS INTEGER) AS "Year",
                 CAST(isodow(vl.DiaClave) - 1 AS INTEGER) AS Dia, CAST(weekofyear(vl.DiaClave) AS INTEGER) AS Semana
          FROM ({q['visit_log']}) vl),
        qv AS (SELECT quantile_cont(Visita_seg, {p.visit_p_cut}) AS q FROM v)
        SELECT v.ClienteClave, v.DiaClave, round_even((v.Visita_seg) * CAST(1000000 AS DOUBLE), 0) / CAST(1000000 AS DOUBLE) AS Visita_seg, v.Mes, v."Year", v.Dia, v.Semana,
               round_even((qv.q) * CAST(1000000 AS DOUBLE), 0) / CAST(1000000 AS DOUBLE) AS p_value FROM v, qv WHERE v.Visita_seg <= qv.q"""
    q.update(_stage_queries(p))
    return q


def _split_case(p: PlanParams) -> str:
    b = f"CAST('0x' || substr(md5(concat_ws('|', ClienteClave, CAST(Semana AS VARCHAR), CAST(Dia AS VARCHAR))), 1, 8) AS BIGINT) % {p.split_buckets}"
    return f"CASE WHEN {b} < {p.split_train} THEN 'train' WHEN {b} < {p.split_train + p.split_val} THEN 'val' ELSE 'test' END"


def _stage_queries(p: PlanParams) -> dict[str, str]:
    days = _days(p)
    q: dict[str, str] = {}
    q["num_weeks"] = "SELECT n AS num_semanas FROM nweeks"
    q["weekly_visits"] = "SELECT * FROM weekly_visits"
    q["weekday_codes"] = "SELECT * FROM codes"
    q["visit_plan"] = "SELECT * FROM visit_plan"
    q["client_weekday_stats"] = f"SELECT ClienteClave, Dia, {_dbl(['Venta_media_por_dia', 'Venta_mediana_por_dia'])} FROM wd_stats"
    q["client_weekday_stats_train"] = f"""WITH kd AS (
          SELECT *, {_split_case(p)} AS split FROM (SELECT DISTINCT ClienteClave, Fecha, Semana, Dia, CAST(Venta_Total_dia AS DECIMAL(20, 3)) AS v FROM p_sales) t),
        kt AS (SELECT * FROM kd WHERE split = 'train'),
        dd AS (SELECT ClienteClave, Semana, Dia, Fecha, CAST(Venta_Total_dia AS DECIMAL(20, 3)) AS v, {_split_case(p)} AS split FROM daily),
        wo AS (SELECT d.ClienteClave, d.Semana, d.Dia, sum(k.v) AS s, count(k.v) AS n, median(CAST(k.v AS DOUBLE)) AS md FROM dd d
               JOIN kt k ON k.ClienteClave = d.ClienteClave AND k.Dia = d.Dia AND k.Fecha <> d.Fecha GROUP BY 1, 2, 3),
        co AS (SELECT d.ClienteClave, d.Semana, d.Dia, sum(k.v) AS s, count(k.v) AS n FROM dd d
               JOIN kt k ON k.ClienteClave = d.ClienteClave AND k.Fecha <> d.Fecha GROUP BY 1, 2, 3),
        ga AS (SELECT sum(v) AS s, count(*) AS n FROM kt),
        wa AS (SELECT ClienteClave, Dia, CAST(sum(v) AS DOUBLE) / count(*) AS m FROM kt GROUP BY 1, 2),
        ca AS (SELECT ClienteClave, CAST(sum(v) AS DOUBLE) / count(*) AS m FROM kt GROUP BY 1),
        x AS (SELECT d.*, coalesce(CAST(wo.s AS DOUBLE) / wo.n, CAST(co.s AS DOUBLE) / co.n,
                CASE WHEN d.split = 'train' THEN CAST(ga.s - d.v AS DOUBLE) / (ga.n - 1) ELSE CAST(ga.s AS DOUBLE) / ga.n END) AS loo, wo.md,
                coalesce(wa.m, ca.m, CAST(ga.s AS DOUBLE) / ga.n) AS pl
              FROM dd d LEFT JOIN wo ON wo.ClienteClave = d.ClienteClave AND wo.Semana = d.Semana AND wo.Dia = d.Dia
              LEFT JOIN co ON co.ClienteClave = d.ClienteClave AND co.Semana = d.Semana AND co.Dia = d.Dia
              LEFT JOIN wa ON wa.ClienteClave = d.ClienteClave AND wa.Dia = d.Dia LEFT JOIN ca ON ca.ClienteClave = d.ClienteClave, ga)
        SELECT ClienteClave, Semana, Dia, split, {r6('loo', 'Venta_media_por_dia')}, {r6('coalesce(md, loo)', 'Venta_mediana_por_dia')}, {r6('pl', 'Venta_media_plan')} FROM x"""
    dcols = ["Venta_Total_dia", "Valor_Z_general", "Valor_Z_detalle", "Venta_media_por_dia", "Venta_mediana_por_dia"]
    base = 'ClienteClave, Semana, Dia, Fecha, UNE, Ruta, EsquemaID, Mes, "Year", Visitas_Semanales'
    q["daily_dataset"] = f"SELECT {base}, {_dbl(dcols)} FROM daily"
    q["bands"] = f"SELECT {base}, Categoria, {_dbl(dcols + ['q1', 'q2', 'q3'])} FROM banded"
    q["band_mode"] = "SELECT * FROM band_mode"
    q["warm_plan"] = f"SELECT ClienteClave, EsquemaID, Dia, Visitas_Semanales, Categoria, Mes, Semana, {r6('Venta_media_por_dia')} FROM warm"
    q["cold_clients"] = "SELECT * FROM cold"
    q["client_attrs"] = "SELECT * FROM client_attrs"
    q["curve_grid"] = f"SELECT EsquemaID, Visitas_Semanales, Semana, {r6('Venta_Total_dia')} FROM curve_grid"
    q["curve_filled"] = f"SELECT EsquemaID, Visitas_Semanales, Semana, {r6('Venta_Total_dia')} FROM curve_filled"
    q["curve_smooth"] = f"SELECT EsquemaID, Visitas_Semanales, Semana, {_dbl(['Venta_Total_dia', 'prediccion'])} FROM curves"
    q["curve_forecast"] = f"SELECT ClienteClave, EsquemaID, Semana, Dia, Visitas_Semanales, {r6('prediccion')} FROM curve_forecast"
    q["forecast_union"] = f"SELECT ClienteClave, EsquemaID, Semana, Dia, Visitas_Semanales, {r6('prediccion')} FROM fc"
    q["weekly_forecast"] = f"SELECT ClienteClave, UNE, Ruta, EsquemaID, Semana, Visitas_Semanales, {r6('prediccion')} FROM weekly"
    q["day_mix"] = f"SELECT ClienteClave, ProductoClave, {_dbl(days + ['Porcentaje'])} FROM day_mix"
    q["mix_clean"] = f"""SELECT UNE, ClienteClave, ProductoClave, Fecha, TransProdID, TransProdDetalleID,
        {_dbl(['KgLts_Total', 'Valor_Z'])} FROM mix_clean"""
    q["mix_median"] = f"SELECT UNE, ClienteClave, ProductoClave, {r6('KgLts_Total')} FROM mix_median"
    q["mix_vectors"] = f"""SELECT c.UNE, c.ClienteClave, CAST(u.idx AS INT) AS idx, {r6('coalesce(m.Porcentaje, 0.0)', 'valor')}
        FROM (SELECT DISTINCT UNE, ClienteClave FROM mix_long) c
        JOIN (SELECT UNE, ProductoClave, row_number() OVER (PARTITION BY UNE ORDER BY ProductoClave) - 1 AS idx FROM (SELECT DISTINCT UNE, ProductoClave FROM mix_long)) u ON c.UNE = u.UNE
        LEFT JOIN mix_long m ON m.UNE = c.UNE AND m.ClienteClave = c.ClienteClave AND m.ProductoClave = u.ProductoClave"""
    cats = ["EsquemaID", "Semana", "Mes", "Dia", "Categoria"]
    levels = " UNION ALL ".join(f"SELECT {i} AS c, CAST({c} AS VARCHAR) AS l FROM banded GROUP BY ALL" for i, c in enumerate(cats))
    hot = " UNION ALL ".join(f"SELECT b.ClienteClave, b.Semana, b.Dia, o.i AS idx, CAST(1.0 AS DOUBLE) AS valor FROM banded b JOIN lv o ON o.c = {i} AND o.l = CAST(b.{c} AS VARCHAR)" for i, c in enumerate(cats))
    nums = " UNION ALL ".join(f"SELECT ClienteClave, Semana, Dia, (SELECT count(*) FROM lv) + {i}, CAST({c} AS DOUBLE) FROM banded" for i, c in enumerate(["Visitas_Semanales", "Venta_media_por_dia"]))
    q["features_long"] = f"""WITH lv AS (SELECT c, l, row_number() OVER (ORDER BY c, l COLLATE "C") - 1 AS i FROM ({levels}) t),
        f AS ({hot} UNION ALL {nums})
        SELECT ClienteClave, Semana, Dia, CAST(idx AS INT) AS idx, {r6('valor')} FROM f WHERE valor <> 0"""
    q["weekly_series"] = f"""SELECT * FROM (SELECT Semana, {r6('sum(prediccion)', 'Volumen')}, 'prediccion' AS Serie FROM weekly GROUP BY Semana
        UNION ALL SELECT Semana, {r6('sum(KgLts_Total)', 'Volumen')}, 'real' AS Serie FROM sales GROUP BY Semana) t"""
    q["split"] = f"SELECT ClienteClave, Semana, Dia, {_split_case(p)} AS split FROM daily"
    q["product_mix"] = f"SELECT UNE, ClienteClave, ProductoClave, {r6('Porcentaje')} FROM mix_long"
    q["cluster_mix"] = f"SELECT UNE, ClienteClave, Cluster, ProductoClave, {r6('Porcentaje_kmeans')} FROM cluster_mix"
    q["running_share"] = f"SELECT ClienteClave, ProductoClave, {_dbl(days + ['Porcentaje', 'Agg'])} FROM rs"
    q["unblended_clients"] = f"SELECT ClienteClave, ProductoClave, {_dbl(days + ['Porcentaje'])} FROM unblended"
    q["blend"] = f"SELECT ClienteClave, ProductoClave, {_dbl(days + ['Porcentaje'])} FROM blend"
    dl, ddiv = ", ".join(days), ", ".join(f"coalesce(sum(CASE WHEN s.Dia = {d} THEN s.KgLts_Total END), 0.0) / NULLIF(sum(s.KgLts_Total), 0) AS {n}" for d, n in p.days)
    w = p.blend_weight
    cdl = ", ".join("f." + n for n in days)
    q["blend_new_products"] = f"""WITH prof AS (SELECT a.UNE, a.Cluster, s.ProductoClave, {ddiv} FROM p_sales s
          JOIN assign a ON a.UNE = s.UNE AND a.ClienteClave = s.ClienteClave GROUP BY 1, 2, 3),
        old AS (SELECT h.ClienteClave, h.ProductoClave, {", ".join("h." + n for n in days)},
              CASE WHEN a.ClienteClave IS NULL THEN h.Porcentaje ELSE {1.0 - w!r} * h.Porcentaje + {w!r} * coalesce(c.Porcentaje_kmeans, 0.0) END AS Porcentaje
              FROM day_mix h LEFT JOIN assign a ON a.ClienteClave = h.ClienteClave
              LEFT JOIN centres c ON c.UNE = a.UNE AND c.Cluster = a.Cluster AND c.ProductoClave = h.ProductoClave),
        fresh AS (SELECT a.ClienteClave, f.ProductoClave, {cdl}, {w!r} * c.Porcentaje_kmeans AS Porcentaje FROM assign a
              JOIN centres c ON c.UNE = a.UNE AND c.Cluster = a.Cluster JOIN prof f ON f.UNE = c.UNE AND f.Cluster = c.Cluster AND f.ProductoClave = c.ProductoClave
              WHERE c.Porcentaje_kmeans > 0 AND a.ClienteClave IN (SELECT ClienteClave FROM day_mix)
              AND NOT EXISTS (SELECT 1 FROM day_mix h WHERE h.ClienteClave = a.ClienteClave AND h.ProductoClave = c.ProductoClave)),
        nall AS (SELECT * FROM old UNION ALL SELECT * FROM fresh),
        nrs AS (SELECT *, sum(Porcentaje) OVER (PARTITION BY ClienteClave ORDER BY Porcentaje DESC, ProductoClave ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS Agg FROM nall),
        nkept AS (SELECT * FROM nrs WHERE round(Agg, {p.share_decimals}) < {p.share_cut!r}),
        nout AS (SELECT ClienteClave, ProductoClave, {dl}, (Porcentaje * 100.0 / sum(Porcentaje) OVER (PARTITION BY ClienteClave)) / 100.0 AS Porcentaje FROM nkept
              UNION ALL SELECT ClienteClave, ProductoClave, {dl}, CAST(1.0 AS DOUBLE) FROM (SELECT *, row_number() OVER (PARTITION BY ClienteClave ORDER BY Porcentaje DESC, ProductoClave) AS r
                FROM nall WHERE ClienteClave NOT IN (SELECT ClienteClave FROM nkept)) t WHERE r = 1)
        SELECT ClienteClave, ProductoClave, {_dbl(days + ['Porcentaje'])} FROM nout WHERE ClienteClave IN (SELECT ClienteClave FROM fc)"""
    q["day_volume"] = f"""SELECT ClienteClave, UNE, Ruta, EsquemaID, Semana, Visitas_Semanales, ProductoClave,
        {_dbl(days + ['Porcentaje'])} FROM day_volume"""
    q["unit_min"] = f"SELECT ProductoClave, {r6('KgLts')} FROM unit_min"
    q["pieces"] = f"SELECT UNE, Ruta, ClienteClave, ProductoClave, Dia, {_dbl(['Piezas', 'Litros'])} FROM pieces"
    q["route_load"] = f"""SELECT UNE, Ruta, Material, Dia,
        {_dbl(['Piezas', 'Litros', 'Rejas', 'Piezas_en_rejas', 'Litros_en_rejas'])} FROM route_load"""
    q["crate_round"] = f"SELECT UNE, Ruta, Material, Dia, {_dbl(['Piezas', 'Unidad_de_Carga', 'Rejas'])} FROM crate_round"
    q["plan_totals"] = f"""SELECT count(*) AS n_rows, {r6('sum(Piezas)', 'Piezas')}, {r6('sum(Litros)', 'Litros')},
        {r6('sum(Rejas)', 'Rejas')}, {r6('sum(Litros_en_rejas)', 'Litros_en_rejas')},
        {r6('min(Litros_en_rejas)', 'min_litros_en_rejas')}, {r6('max(Litros_en_rejas)', 'max_litros_en_rejas')} FROM route_load"""
    # reports
    q["product_share"] = f"""SELECT ProductoClave, {r6('sum(KgLts_Total)', 'KgLts_Total')},
        {r6('sum(KgLts_Total) * 100.0 / sum(sum(KgLts_Total)) OVER ()', 'pct')} FROM sales GROUP BY ProductoClave"""
    q["weekly_trend"] = f"""SELECT "Year", Semana, {r6('sum(KgLts_Total)', 'KgLts_Total')},
        CAST(make_date("Year", 1, 1) + 7 * Semana AS DATE) AS Fecha FROM sales GROUP BY "Year", Semana"""
    q["client_weekly"] = f"""SELECT ClienteClave, Semana, "Year", {r6('sum(KgLts_Total)', 'KgLts_Total')} FROM sales
        GROUP BY ClienteClave, Semana, 3"""
    q["client_weekly_clean"] = f"""SELECT ClienteClave, Semana, "Year", {r6('sum(KgLts_Total)', 'KgLts_Total')} FROM clean
        GROUP BY ClienteClave, Semana, 3"""
    cw = 'SELECT ClienteClave, Semana, "Year", sum(KgLts_Total) AS x FROM sales GROUP BY ClienteClave, Semana, "Year"'
    q["client_weekly_hist"] = f"""WITH cw AS ({cw}), mm AS (SELECT min(x) AS lo, max(x) AS hi FROM cw),
        b AS (SELECT CAST(least(floor({HIST_BINS} * (x - lo) / (hi - lo)) + 1, {HIST_BINS}) AS INTEGER) AS bin, lo, hi FROM cw, mm)
        SELECT bin, {r6('min(lo) + (bin - 1) * ((min(hi) - min(lo)) / ' + str(HIST_BINS) + ')', 'lo')},
               {r6('min(lo) + bin * ((min(hi) - min(lo)) / ' + str(HIST_BINS) + ')', 'hi')}, count(*) AS n FROM b GROUP BY bin"""
    q["describe_weekly"] = f"""WITH cw AS ({cw}) SELECT count(x) AS count, {r6('avg(x)', 'mean')}, {r6('stddev_samp(x)', 'std')},
        {r6('min(x)', 'min')}, {r6('quantile_cont(x, 0.25)', 'p25')}, {r6('quantile_cont(x, 0.5)', 'p50')},
        {r6('quantile_cont(x, 0.75)', 'p75')}, {r6('max(x)', 'max')} FROM cw"""
    box = lambda src, stage: f"""SELECT '{stage}' AS stage, count(v) AS n, {r6('min(v)', 'min')}, {r6('q1')}, {r6('q2', 'median')}, {r6('q3')},
        {r6('max(v)', 'max')}, {r6('q1 - 1.5 * (q3 - q1)', 'fence_lo')}, {r6('q3 + 1.5 * (q3 - q1)', 'fence_hi')},
        count(CASE WHEN v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1) THEN 1 END) AS n_outliers
        FROM (SELECT Venta_Total_dia AS v FROM {src}) s, (SELECT quantile_cont(Venta_Total_dia, 0.25) AS q1,
        quantile_cont(Venta_Total_dia, 0.5) AS q2, quantile_cont(Venta_Total_dia, 0.75) AS q3 FROM {src}) q GROUP BY q1, q2, q3"""  # noqa: E731
    q["box_stats"] = box("sales_dt", "before") + " UNION ALL " + box("p_sales", "after")
    q["channel_box"] = f"""WITH cw AS (SELECT EsquemaID, sum(KgLts_Total) AS v FROM sales GROUP BY EsquemaID, ClienteClave, "Year", Semana),
        q AS (SELECT EsquemaID, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS q2, quantile_cont(v, 0.75) AS q3 FROM cw GROUP BY EsquemaID)
        SELECT EsquemaID, count(v) AS n, {r6('min(v)', 'min')}, {r6('q1')}, {r6('q2', 'median')}, {r6('q3')}, {r6('max(v)', 'max')},
        {r6('q1 - 1.5 * (q3 - q1)', 'fence_lo')}, {r6('q3 + 1.5 * (q3 - q1)', 'fence_hi')},
        count(CASE WHEN v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1) THEN 1 END) AS n_outliers
        FROM cw JOIN q USING (EsquemaID) GROUP BY EsquemaID, q1, q2, q3"""
    q["channel_trend"] = f"""SELECT EsquemaID, "Year", Semana, {r6('sum(cw)', 'KgLts_Total')}, {r6('stddev_samp(cw)', 'std_cliente')},
        count(*) AS n_clientes FROM (SELECT EsquemaID, ClienteClave, "Year", Semana, sum(KgLts_Total) AS cw FROM sales
        GROUP BY 1, 2, 3, 4) t GROUP BY EsquemaID, "Year", Semana"""
    units = _lst(p.units)
    dates = f"DATE '{p.start.isoformat()}' AND DATE '{p.end.isoformat()}'"
    q["parse_dates"] = f"""SELECT ClienteClave, DiaTexto, Fecha, CAST(month(Fecha) AS INTEGER) AS Mes, CAST(year(Fecha) AS INTEGER) AS "Year",
        CAST(isodow(Fecha) - 1 AS INTEGER) AS Dia, CAST(weekofyear(Fecha) AS INTEGER) AS Semana
        FROM (SELECT ClienteClave, DiaTexto, CAST(strptime(DiaTexto, '%d/%m/%Y') AS DATE) AS Fecha
              FROM (SELECT ClienteClave, strftime(DiaClave, '%d/%m/%Y') AS DiaTexto FROM agenda
                    WHERE ClaveCEDI IN ({units}) AND DiaClave BETWEEN {dates}) a) b"""
    q["regression_metrics"] = f"""SELECT count(*) AS n,
        {r6('1.0 - sum((y - yh) * (y - yh)) / sum((y - mu) * (y - mu))', 'R2')},
        {r6('avg(abs(y - yh))', 'MAE')}, {r6('sqrt(avg((y - yh) * (y - yh)))', 'RMSE')}
        FROM (SELECT Venta_Total_dia AS y, Venta_media_por_dia AS yh FROM daily) d, (SELECT avg(Venta_Total_dia) AS mu FROM daily) m"""
    q["compare_weekly"] = f"""WITH f AS (SELECT Semana, sum(Venta_media_por_dia) * {p.uplift!r} AS forecast FROM daily GROUP BY Semana),
        a AS (SELECT Semana, sum(Venta_Total_dia) AS actual FROM daily GROUP BY Semana),
        j AS (SELECT f.Semana, forecast, actual, forecast - actual AS error,
              (forecast - actual) * 100.0 / NULLIF(actual, 0) AS pct_error FROM f JOIN a ON f.Semana = a.Semana)
        SELECT Semana, {_dbl(['forecast', 'actual', 'error', 'pct_error'])},
        {r6('avg(abs(pct_error)) OVER ()', 'mape')}, {r6('avg(abs(error)) OVER ()', 'mae')},
        {r6('sqrt(avg(error * error) OVER ())', 'rmse')},
        {r6('(sum(forecast) OVER () - sum(actual) OVER ()) * 100.0 / sum(actual) OVER ()', 'bias_pct')} FROM j"""
    return q


HIST_BINS = 20


def oracle_sql(p: PlanParams | None = None) -> dict[str, str]:
    p = p or fixture_params()
    out = {}
    for k, sel in _queries(p).items():
        out[k] = with_chain(sel, p) if not sel.lstrip().upper().startswith("WITH") else _nest(sel, p)
    out["backtest"] = _backtest(p)
    return out


def _backtest(p: PlanParams) -> str:
    """Every origin is the whole chain over sales that end the day before."""
    parts = []
    for o in p.backtest_origins:
        first = [o + dt.timedelta(weeks=h) for h in range(p.backtest_weeks)]
        target = ", ".join(f"({h + 1}, DATE '{d}', {d.isocalendar()[1]})" for h, d in enumerate(first))
        parts.append(with_chain(f"""SELECT DATE '{o}' AS Origen, h.h AS Horizonte, h.d AS Desde, h.s AS Semana,
          (coalesce((SELECT sum(v.Venta_media_por_dia) FROM warm v JOIN client_attrs a ON a.ClienteClave = v.ClienteClave), 0.0) + coalesce(c.f, 0.0)) * {p.uplift!r} AS forecast
          FROM (VALUES {target}) h(h, d, s) LEFT JOIN (
            SELECT cv.Semana, sum(cv.prediccion / k.Visitas_Semanales) AS f FROM plan_days d JOIN cold k ON d.ClienteClave = k.ClienteClave
            JOIN client_attrs a ON a.ClienteClave = k.ClienteClave
            JOIN curves cv ON k.EsquemaID = cv.EsquemaID AND k.Visitas_Semanales = cv.Visitas_Semanales GROUP BY cv.Semana) c ON c.Semana = h.s""", p.with_(end=o - dt.timedelta(days=1))))
    body = " UNION ALL ".join(f"SELECT * FROM ({x})" for x in parts)
    chain = ",\n".join(f"{n} AS (\n{sql}\n)" for n, sql in fixture_ctes() + plan_ctes(p))
    return f"""WITH {chain}, forecasts AS ({body}),
        j AS (SELECT f.*, coalesce((SELECT sum(KgLts_Total) FROM sales s WHERE s.Fecha >= f.Desde AND s.Fecha < f.Desde + INTERVAL 7 DAY), 0.0) AS actual FROM forecasts f),
        e AS (SELECT *, forecast - actual AS error, (forecast - actual) * 100.0 / NULLIF(actual, 0) AS pct_error FROM j)
        SELECT Origen, Horizonte, Desde, Semana, {_dbl(['forecast', 'actual', 'error', 'pct_error'])},
        {r6('avg(abs(pct_error)) OVER (PARTITION BY Origen)', 'mape_origen')}, {r6('avg(abs(pct_error)) OVER (PARTITION BY Horizonte)', 'mape_horizonte')} FROM e"""


def _nest(sel: str, p: PlanParams) -> str:
    """A statement with its own WITH: append its CTEs after the chain's."""
    inner = sel.lstrip()[4:]
    ctes = fixture_ctes() + plan_ctes(p)
    body = ",\n".join(f"{n} AS (\n{sql}\n)" for n, sql in ctes)
    return f"WITH {body},\n{inner}"
