"""SQL that gives the same result as each query of :mod:`tillrecon.plans.table_queries`."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

TICKETS = """tickets AS (
  SELECT o_orderkey AS block_id,
         CAST(o_custkey % 2 AS VARCHAR) AS shop,
         o_orderstatus AS type,
         lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS internal_no,
         CASE WHEN o_orderkey % 10 = 0 THEN '  '
              ELSE lpad(CAST(o_orderkey AS VARCHAR), 12, '0') END AS ticket_no,
         CAST(o_orderdate AS DATE) AS ticket_date,
         lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || ':' ||
         lpad(CAST(o_orderkey % 60 AS VARCHAR), 2, '0') AS ticket_time,
         CAST(round(o_totalprice * 100) AS BIGINT) AS ttc,
         substr(o_orderpriority, 1, 1) AS means,
         (CAST(round(o_totalprice * 100) AS BIGINT) * 5) // 6 AS ht1,
         CAST(round(o_totalprice * 100) AS BIGINT)
           - (CAST(round(o_totalprice * 100) AS BIGINT) * 5) // 6 AS vat1,
         CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2')
              THEN CAST(round(o_totalprice * 100) AS BIGINT) END AS pay_card,
         CASE WHEN substr(o_orderpriority, 1, 1) = '3'
              THEN CAST(round(o_totalprice * 100) AS BIGINT) END AS pay_cheque,
         CASE WHEN substr(o_orderpriority, 1, 1) IN ('4', '5')
              THEN CAST(round(o_totalprice * 100) AS BIGINT) END AS pay_cash,
         CAST(year(o_orderdate) AS INTEGER) AS year,
         strftime(o_orderdate, '%Y-%m') AS period
  FROM orders)"""

ITEMS = """items AS (
  SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS amount,
         CAST(year(l_shipdate) AS INTEGER) AS year, strftime(l_shipdate, '%Y-%m') AS period
  FROM lineitem)"""

ROWS = """rows_ AS (
  SELECT event_id, CAST(year(ts) AS INTEGER) AS year, strftime(ts, '%Y-%m-%d') AS period,
         CASE user_id % 3 WHEN 0 THEN 'Z' WHEN 1 THEN 'ZZ1' ELSE 'ZZ2' END AS mode,
         event_type AS nature, CAST(round(value * 100) AS BIGINT) AS amount
  FROM events)"""

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def big(expression: str, alias: str) -> str:
    return f"CAST({expression} AS BIGINT) AS {alias}"


def natures(suffix: str = "") -> str:
    """Count and amount per nature."""
    parts = []
    for n in EVENT_TYPES:
        parts.append(big(f"count(*) FILTER (WHERE nature = '{n}')", f"{n}_qty{suffix}"))
        parts.append(
            big(f"coalesce(sum(amount) FILTER (WHERE nature = '{n}'), 0)", f"{n}_amount{suffix}")
        )
    return ", ".join(parts)


REVENUE_SIDES = f"""{TICKETS}, {ITEMS},
l AS (SELECT year, period, sum(amount) AS ttc, sum((amount * 5) // 6) AS ht,
             sum(amount - (amount * 5) // 6) AS vat FROM items GROUP BY ALL),
r AS (SELECT year, period, sum(ttc) AS ttc, sum(ht1) AS ht, sum(vat1) AS vat
      FROM tickets GROUP BY ALL)"""

STATUS = """CASE WHEN r.period IS NULL THEN 'left_only'
            WHEN l.period IS NULL THEN 'right_only' ELSE 'both' END"""

ORACLES["reconcile_null"] = f"""
WITH {REVENUE_SIDES}
SELECT year, period, {big('l.ttc - r.ttc', 'gap_ttc')}, {big('l.ht - r.ht', 'gap_ht')},
       {big('l.vat - r.vat', 'gap_vat')}, {STATUS} AS status
FROM l FULL JOIN r USING (year, period)"""

ORACLES["missing_periods"] = f"""
WITH {REVENUE_SIDES}
SELECT year, period, CASE WHEN r.period IS NULL THEN 'right' ELSE 'left' END AS absent_from
FROM l FULL JOIN r USING (year, period)
WHERE l.period IS NULL OR r.period IS NULL"""

ORACLES["monthly_revenue"] = f"""
WITH {TICKETS}
SELECT shop, year, period, {big('sum(ht1)', 'total_ht')}, {big('sum(vat1)', 'total_vat20')},
       {big('sum(ttc)', 'ttc')}
FROM tickets GROUP BY shop, year, period"""

ORACLES["monthly_payments"] = f"""
WITH {TICKETS}
SELECT shop, year, period, {big('sum(ttc)', 'ttc')}, {big('sum(pay_card)', 'pay_card')},
       {big('sum(pay_cheque)', 'pay_cheque')}, {big('sum(pay_cash)', 'pay_cash')}
FROM tickets GROUP BY shop, year, period"""

ORACLES["reconcile_payments"] = f"""
WITH {TICKETS}, {ITEMS},
l AS (SELECT CAST(l_suppkey % 2 AS VARCHAR) AS shop, year, period,
             sum(amount) FILTER (WHERE l_returnflag = 'A') AS card,
             sum(amount) FILTER (WHERE l_returnflag = 'N') AS cheque,
             sum(amount) FILTER (WHERE l_returnflag = 'R') AS cash
      FROM items
      WHERE (l_suppkey % 2 = 0 AND l_linestatus = 'F') OR (l_suppkey % 2 = 1 AND l_linestatus = 'O')
      GROUP BY ALL),
r AS (SELECT shop, year, period, sum(pay_card) AS card, sum(pay_cheque) AS cheque,
             sum(pay_cash) AS cash FROM tickets GROUP BY ALL)
SELECT shop, year, period,
       {', '.join(big(f"CASE WHEN l.period IS NOT NULL AND r.period IS NOT NULL THEN coalesce(l.{m}, 0) - coalesce(r.{m}, 0) END", f'gap_{m}') for m in ('card', 'cheque', 'cash'))},
       {STATUS} AS status
FROM l FULL JOIN r USING (shop, year, period)"""

ORACLES["z2_mode_totals"] = f"""
WITH {ROWS}
SELECT year, period, {natures()} FROM rows_ WHERE mode = 'ZZ1' GROUP BY year, period"""

ORACLES["reconcile_zero"] = f"""
WITH {ROWS},
l AS (SELECT year, period, {natures()} FROM rows_ WHERE mode = 'ZZ1' GROUP BY year, period),
r AS (SELECT year, period, {natures()} FROM rows_ WHERE mode = 'ZZ2' GROUP BY year, period)
SELECT year, period,
       {', '.join(big(f"coalesce(l.{n}_{m}, 0) - coalesce(r.{n}_{m}, 0)", f"{n}_{m}") for n in EVENT_TYPES for m in ('qty', 'amount'))},
       {STATUS} AS status
FROM l FULL JOIN r USING (year, period)"""

ORACLES["pivot_control"] = f"""
WITH {ROWS}
SELECT mode, year, period, {natures()}, 0 AS differs FROM rows_ GROUP BY mode, year, period"""

CONSOLIDATED = f"""{TICKETS},
shops AS (SELECT year, period, shop, sum(ht1) AS ht, sum(vat1) AS vat, sum(ttc) AS ttc
          FROM tickets GROUP BY ALL)"""

ORACLES["consolidate"] = f"""
WITH {CONSOLIDATED}
SELECT year, period,
       {big("a.ht", "s0_total_ht")}, {big("a.vat", "s0_total_vat20")}, {big("a.ttc", "s0_ttc")},
       {big("b.ht", "s1_total_ht")}, {big("b.vat", "s1_total_vat20")}, {big("b.ttc", "s1_ttc")},
       {big("a.ht + b.ht", "total_total_ht")}, {big("a.vat + b.vat", "total_total_vat20")},
       {big("a.ttc + b.ttc", "total_ttc")}
FROM (SELECT * FROM shops WHERE shop = '0') a
FULL JOIN (SELECT * FROM shops WHERE shop = '1') b USING (year, period)"""

ORACLES["consolidate_strict"] = ORACLES["consolidate"].replace("FULL JOIN", "JOIN")

ORACLES["control_differs"] = f"""
WITH {ROWS}
SELECT DISTINCT mode, year, period FROM rows_ WHERE nature = 'view' AND substr(period, 9, 2) <= '10'"""

ORACLES["compare_declared"] = f"""
WITH {CONSOLIDATED},
own AS (SELECT year, period, a.ht + b.ht AS ht, a.vat + b.vat AS vat, a.ttc + b.ttc AS ttc
        FROM (SELECT * FROM shops WHERE shop = '0') a
        FULL JOIN (SELECT * FROM shops WHERE shop = '1') b USING (year, period)),
declared AS (SELECT year, period, sum(ht1) AS ht, sum(vat1) AS vat
             FROM tickets WHERE type = 'F' AND month(ticket_date) <= 6 GROUP BY year, period)
SELECT o.year, o.period, {big('o.ht', 'total_total_ht')}, {big('o.vat', 'total_total_vat20')},
       {big('o.ttc', 'total_ttc')}, {big('d.ht', 'ht20_declared')}, {big('d.vat', 'vat20_declared')},
       {big('o.ht - d.ht', 'gap_ht20')}, {big('o.vat - d.vat', 'gap_vat20')}
FROM own o LEFT JOIN declared d USING (year, period)"""

SYNTHESIS = f"""{ITEMS},
rows_ AS (
  SELECT CASE WHEN l_partkey % 2 = 0 THEN 'A' ELSE 'B' END AS shop,
         CASE l_suppkey % 3 WHEN 0 THEN 'Z' WHEN 1 THEN 'ZZ1' ELSE 'ZZ2' END AS mode,
         year, period, amount,
         CASE l_returnflag || l_linestatus
           WHEN 'AF' THEN 'CA BRUT' WHEN 'AO' THEN 'CA NET' WHEN 'NF' THEN 'HORS TAXES 1'
           WHEN 'NO' THEN 'HORS TAXES 1' WHEN 'RF' THEN 'TVA 1' ELSE 'ESP.TIROIR' END AS name
  FROM items)"""
NOT_EXCLUDED = """NOT ((shop = 'A' AND mode = 'Z' AND year = 1994) OR (shop = 'B' AND mode = 'ZZ2' AND year = 1996))"""

ORACLES["applicable_modes"] = f"""
WITH {SYNTHESIS}
SELECT DISTINCT mode, shop, year,
       CASE WHEN mode = 'Z' AND shop = 'A' AND year = 1998 THEN 'ZZ2' ELSE mode END AS resolved_mode
FROM rows_ WHERE {NOT_EXCLUDED}"""

ORACLES["z1_mode_totals"] = f"""
WITH {SYNTHESIS}
SELECT mode, shop, year, period,
       {', '.join(big(f"coalesce(sum(amount) FILTER (WHERE name = '{n}'), 0)", a) for n, a in (('CA BRUT', 'CA_BRUT'), ('CA NET', 'CA_NET'), ('ESP.TIROIR', 'ESP_TIROIR'), ('HORS TAXES 1', 'HORS_TAXES_1'), ('TVA 1', 'TVA_1')))}
FROM rows_ WHERE {NOT_EXCLUDED} GROUP BY mode, shop, year, period"""

ORACLES["occurrence_matrix"] = f"""
WITH {ITEMS}
SELECT year, period,
       {', '.join(big(f"nullif(count(*) FILTER (WHERE l_returnflag = '{f}' AND l_linestatus = '{s}'), 0)", f"{f}_{s}") for f in 'ANR' for s in 'FO')}
FROM items GROUP BY year, period"""

ORACLES["totals_and_period"] = f"""
WITH {TICKETS}
SELECT block_id, {big('ht1', 'total_ht')}, {big('vat1', 'total_vat20')}, year, period FROM tickets"""

ORACLES["sales_only"] = f"""
WITH {TICKETS}
SELECT block_id, shop, year, type, ticket_no FROM tickets
WHERE type IN ('F', 'P') AND nullif(trim(ticket_no), '') IS NOT NULL"""

ORACLES["sales_shop_year"] = f"""
WITH {TICKETS}
SELECT block_id, shop, year, type, ticket_no FROM tickets
WHERE type IN ('F', 'P') AND nullif(trim(ticket_no), '') IS NOT NULL AND shop = '1' AND year = 1995"""

ORACLES["ordered_headers"] = f"""
WITH {TICKETS}
SELECT shop, row_number() OVER (PARTITION BY shop ORDER BY ticket_date, ticket_time, internal_no)
         AS position, block_id
FROM tickets"""

ORACLES["ordered_lines"] = f"""
WITH {TICKETS}, {ITEMS}
SELECT shop, row_number() OVER (
         PARTITION BY shop
         ORDER BY ticket_date, ticket_time, internal_no, l_linenumber, l_partkey, l_suppkey, amount,
                  l_quantity, l_shipdate) AS position,
       block_id, l_linenumber AS line_pos, l_partkey AS part, amount
FROM items JOIN tickets ON l_orderkey = block_id"""

ORACLES["ordered_reports"] = f"""
WITH {ROWS}
SELECT row_number() OVER (ORDER BY mode, period, event_id) AS position, mode, period, event_id
FROM rows_"""

ORACLES["report_rows"] = f"""
WITH {ITEMS}
SELECT l_orderkey AS report_id, l_linenumber, amount, o_orderpriority AS mode
FROM items JOIN orders ON l_orderkey = o_orderkey"""

ORACLES["header_coherence"] = f"""
WITH {TICKETS},
s AS (SELECT block_id, CASE WHEN type = 'P' THEN -1 ELSE 1 END AS sign, ht1, vat1, ttc,
             coalesce(pay_card, 0) + coalesce(pay_cheque, 0) AS paid FROM tickets)
SELECT block_id, {big('sign * ttc', 'ttc')}, {big('sign * ht1 * 20', 'vat_expected')},
       {big('sign * (vat1 * 100 - ht1 * 20)', 'vat_gap')},
       {big('sign * (ht1 + vat1)', 'ttc_expected')},
       {big('sign * (ttc - ht1 - vat1)', 'ttc_gap')},
       {big('sign * (ttc - paid)', 'balance_due')}
FROM s"""

ORACLES["sequence_gaps"] = f"""
WITH {TICKETS},
p AS (SELECT *, lag(ticket_no) OVER (PARTITION BY shop ORDER BY internal_no) AS previous FROM tickets)
SELECT shop, internal_no, ticket_no,
       TRY_CAST(nullif(trim(ticket_no), '') AS BIGINT)
         - TRY_CAST(nullif(trim(previous), '') AS BIGINT) AS gap
FROM p"""

ORACLES["fill_down"] = f"""
WITH {TICKETS},
b AS (SELECT *, CASE WHEN block_id % 5 = 0 THEN means END AS label FROM tickets)
SELECT shop, internal_no, label,
       last_value(label IGNORE NULLS) OVER (
         PARTITION BY shop ORDER BY ticket_date, internal_no
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled
FROM b"""

ORACLES["occurrences_ticket"] = """
SELECT l_orderkey, count(*) AS occurrences FROM lineitem GROUP BY l_orderkey"""

ORACLES["occurrences_label"] = """
SELECT p_name, count(p_name) AS occurrences FROM part GROUP BY p_name"""

ORACLES["occurrences_vat"] = """
SELECT vat_code, count(vat_code) AS occurrences
FROM (SELECT CASE WHEN l_returnflag <> 'N' THEN 'T' || CAST(l_linenumber AS VARCHAR) END AS vat_code
      FROM lineitem) GROUP BY vat_code"""

ORACLES["duplicates"] = """
SELECT l_orderkey, l_linenumber, count(*) AS occurrences
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""

LINE_SUMS = f"""{TICKETS}, {ITEMS},
t AS (SELECT internal_no AS ticket_no, ttc, count(*) FILTER (WHERE l_linestatus = 'F') AS labels,
             sum(amount) AS sum_amount,
             sum(CASE WHEN l_returnflag = 'R' THEN -(amount // 10) END) AS sum_correction
      FROM items JOIN tickets ON l_orderkey = block_id GROUP BY internal_no, ttc)"""

ORACLES["ticket_line_totals"] = f"""
WITH {LINE_SUMS}
SELECT ticket_no, ttc, labels, {big('sum_amount', 'sum_amount')},
       {big('sum_correction', 'sum_correction')} FROM t"""

ORACLES["header_vs_lines"] = f"""
WITH {LINE_SUMS}
SELECT ticket_no, {big('ttc - (sum_amount + coalesce(sum_correction, 0))', 'ttc_gap')} FROM t"""

ORACLES["orphans"] = """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'P')"""

ORACLES["unknown_values"] = """
SELECT DISTINCT o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('F', 'O')"""

METRICS = f"""{TICKETS},
sale AS (SELECT *, type IN ('F', 'P') AND trim(ticket_no) <> '' AS sold FROM tickets),
metrics AS (
  SELECT 'blocks' AS metric, count(*) * 100 AS value FROM sale
  UNION ALL SELECT 'sales', count(*) FILTER (WHERE sold) * 100 FROM sale
  UNION ALL SELECT 'not_sales', count(*) FILTER (WHERE NOT sold) * 100 FROM sale
  UNION ALL SELECT 'returns', count(*) FILTER (WHERE sold AND type = 'P') * 100 FROM sale
  UNION ALL SELECT 'returns_ttc', coalesce(-sum(ttc) FILTER (WHERE sold AND type = 'P'), 0) FROM sale
  UNION ALL SELECT 'sales:' || shop, count(*) FILTER (WHERE sold) * 100 FROM sale GROUP BY shop
  UNION ALL SELECT 'type:' || type, count(*) * 100 FROM sale GROUP BY type
  UNION ALL SELECT 'details', count(*) * 100 FROM lineitem
  UNION ALL SELECT 'report_rows', count(*) * 100 FROM events)"""

ORACLES["volume_metrics"] = f"""
WITH {METRICS}
SELECT metric, {big('value', 'value')} FROM metrics"""

ORACLES["expectations"] = f"""
WITH {METRICS},
expected AS (
  SELECT 'returns' AS metric, 0 AS expected UNION ALL SELECT 'nowhere', 100
  UNION ALL SELECT 'sales:9', 200
  UNION ALL SELECT 'details', count(*) * 100 FROM lineitem)
SELECT metric, {big('expected', 'expected')}, {big('value', 'actual')}
FROM expected LEFT JOIN metrics USING (metric)
WHERE value IS DISTINCT FROM expected"""

ORACLES["money_parse"] = """
WITH p AS (SELECT o_orderkey,
                  CASE WHEN o_orderkey % 6 < 3 THEN CAST(round(o_totalprice * 100) AS BIGINT)
                       WHEN o_orderkey % 6 = 3 THEN -CAST(round(o_totalprice * 100) AS BIGINT)
                  END AS amount FROM orders)
SELECT o_orderkey, amount,
       replace(CAST(CAST(amount / 100.0 AS DECIMAL(18, 2)) AS VARCHAR), '.', ',') AS shown
FROM p"""

ORACLES["period_from_name"] = """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year,
       strftime(o_orderdate, '%Y-%m') AS period FROM orders"""

ORACLES["normalise_scalars"] = """
SELECT o_orderkey,
       CASE WHEN o_orderkey % 5 <> 0 THEN CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR)
            ELSE '' END AS amount_text,
       CASE WHEN o_orderkey % 7 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS iso_date,
       CAST(o_orderkey % 90 AS VARCHAR) AS whole_text,
       CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(month(o_orderdate) AS INTEGER) AS month,
       CASE WHEN o_orderkey % 4 <> 0 THEN trim(o_orderpriority) END AS label,
       CASE WHEN o_orderkey % 4 <> 0
            THEN upper(regexp_replace(o_orderpriority, '[^A-Za-z0-9]', '', 'g')) ELSE '' END AS label_key,
       CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey END AS number
FROM orders"""

ORACLES["contract_text"] = f"""
WITH {TICKETS}
SELECT internal_no, strftime(ticket_date, '%Y-%m-%d') AS ticket_date,
       CAST(CAST(ttc / 100.0 AS DECIMAL(18, 2)) AS VARCHAR) AS ttc,
       coalesce(CAST(CAST(pay_card / 100.0 AS DECIMAL(18, 2)) AS VARCHAR), '') AS pay_card,
       CAST(block_id % 50 AS VARCHAR) AS qty
FROM tickets"""

ORACLES["journal_roundtrip"] = f"""
WITH {TICKETS},
k AS (SELECT *, means <> '5' AS sold, CASE WHEN type = 'P' THEN -1 ELSE 1 END AS sign FROM tickets)
SELECT block_id,
       CASE WHEN NOT sold THEN 'X' WHEN type = 'P' THEN '_R_F' ELSE 'REG' END AS type,
       CASE WHEN sold AND shop = '1' THEN 'REF./TIROIR' END AS event,
       'S' || internal_no || chr(10) || 'END' AS signature, internal_no,
       CASE WHEN sold THEN internal_no END AS ticket_no,
       strftime(ticket_date, '%Y-%m-%d') AS ticket_date, ticket_time,
       {', '.join(big(f'CASE WHEN sold THEN sign * {c} END', c) for c in ('ht1', 'vat1', 'ttc', 'pay_card', 'pay_cash', 'pay_cheque'))},
       0 AS n_errors
FROM k"""

ORACLES["journal_lines_roundtrip"] = f"""
WITH {ITEMS}
SELECT l_orderkey AS block_id, l_linenumber AS item, l_partkey AS part, 1 AS line_pos,
       CAST(l_quantity AS BIGINT) AS qty,
       CASE WHEN l_linestatus = 'F' THEN 'PART ' || CAST(l_partkey AS VARCHAR) END AS label,
       'T' || CAST(l_linenumber % 4 + 1 AS VARCHAR) AS vat_code, amount,
       CAST(NULL AS BIGINT) AS correction
FROM items
UNION ALL
SELECT l_orderkey, l_linenumber, l_partkey, 2, NULL, NULL, NULL, NULL, -(amount // 10)
FROM items WHERE l_returnflag = 'R'"""

PRINTED = """printed AS (
  SELECT l_orderkey AS block_id, CAST(l_quantity AS BIGINT) AS qty,
         CASE WHEN l_linestatus = 'F' THEN 'PART ' || CAST(l_partkey AS VARCHAR) END AS label,
         'T' || CAST(l_linenumber % 4 + 1 AS VARCHAR) AS vat_code, amount, l_returnflag = 'R' AS corrected,
         CASE WHEN t.type = 'P' THEN -1 ELSE 1 END AS sign,
         sum(1 + CAST(l_returnflag = 'R' AS INTEGER)) OVER (
           PARTITION BY l_orderkey
           ORDER BY l_linenumber, l_partkey, l_quantity, amount, l_returnflag = 'R', l_linestatus = 'F'
           ROWS UNBOUNDED PRECEDING) AS last_pos
  FROM items JOIN tickets t ON t.block_id = l_orderkey)"""

ORACLES["journal_full_lines"] = f"""
WITH {TICKETS}, {ITEMS}, {PRINTED}
SELECT block_id, CAST(last_pos - CAST(corrected AS INTEGER) AS INTEGER) AS line_pos, qty, label, vat_code,
       {big('sign * amount', 'amount')}, CAST(NULL AS BIGINT) AS correction
FROM printed
UNION ALL
SELECT block_id, CAST(last_pos AS INTEGER), NULL, NULL, NULL, NULL, -(amount // 10) FROM printed WHERE corrected"""

ORACLES["journal_full_headers"] = f"""
WITH {TICKETS}, {ITEMS}, {PRINTED},
n AS (SELECT block_id, max(last_pos) AS n FROM printed GROUP BY block_id),
k AS (SELECT *, CASE WHEN type = 'P' THEN -1 ELSE 1 END AS sign FROM tickets)
SELECT k.block_id, CASE WHEN type = 'P' THEN '_R_F' ELSE 'REG' END AS type, internal_no AS ticket_no,
       {', '.join(big(f'sign * (k.block_id % 97 + {c}) * 100', f'ht{c}') for c in '1234')},
       {', '.join(big(f'sign * ({c} * 100 + 50)', f'vat{c}') for c in '1234')},
       {big('sign * (k.block_id % 13) * 100', 'ht_exempt')}, {big('sign * ttc', 'ttc')},
       CAST(n AS INTEGER) AS n_lines, 0 AS n_errors
FROM k JOIN n USING (block_id)"""

ORACLES["contract_header"] = """
SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey,
       list_extract(['key|name', 'Key|NAME', 'name|key'], CAST(n_nationkey % 3 + 1 AS INTEGER)) AS header,
       list_extract(['exact', 'case', 'wrong'], CAST(n_nationkey % 3 + 1 AS INTEGER)) AS verdict
FROM nation"""

ORACLES["journal_rejects"] = """
SELECT o_orderkey AS block_id,
       list_extract(['header:format', 'header:date', 'header:time', 'header:internal_no', 'ht:amount',
         'ht:code', 'total:amount', 'exempt:amount', 'correction:amount', 'article:format',
         'card:repeated', 'signature:missing'], CAST(o_orderkey % 12 + 1 AS INTEGER)) AS error
FROM orders WHERE o_orderstatus = 'P'"""

ORACLES["report_roundtrip"] = f"""
WITH {ROWS},
t AS (SELECT period, mode, nature, count(*) AS qty, sum(amount) AS amount,
             row_number() OVER (PARTITION BY period, mode ORDER BY nature) AS n
      FROM rows_ GROUP BY period, mode, nature)
SELECT period || '/' || mode AS report_id, mode, 'TILL-7' AS machine, 'FILE042' AS file_code,
       '0021' AS counter, period AS report_date, CAST(n AS INTEGER) AS line_pos,
       lpad(CAST(n AS VARCHAR), 4, '0') AS record_no, nature AS designation, qty,
       {big('amount', 'amount')}, 0 AS n_errors
FROM t"""

ORACLES["shop_from_path"] = """
SELECT c_custkey, CASE c_nationkey % 4 WHEN 0 THEN 'ALPHA' WHEN 1 THEN 'BETA' END AS shop
FROM customer"""

ORACLES["fingerprint_diff"] = """
WITH b AS (SELECT doc_id, sha256(text) AS h FROM documents WHERE source <> 'src0'),
a AS (SELECT doc_id, sha256(CASE WHEN lang = 'fr' THEN text || '.' ELSE text END) AS h
      FROM documents WHERE lang <> 'de')
SELECT doc_id, b.h AS sha256_before, a.h AS sha256_after,
       CASE WHEN b.doc_id IS NULL THEN 'added' WHEN a.doc_id IS NULL THEN 'removed'
            WHEN a.h = b.h THEN 'same' ELSE 'changed' END AS status
FROM b FULL JOIN a USING (doc_id)"""

ORACLES["numeric_totals"] = f"""
WITH {ITEMS}
SELECT 'qty' AS field, {big('sum(l_quantity) * 100', 'total')} FROM items
UNION ALL SELECT 'amount', CAST(sum(amount) AS BIGINT) FROM items
UNION ALL SELECT 'correction', CAST(-sum(amount // 10) FILTER (WHERE l_returnflag = 'R') AS BIGINT)
FROM items"""

ORACLES["numeric_totals_long"] = f"""
WITH {ROWS}
SELECT nature || ' / qty' AS field, {big('count(*) * 100', 'total')} FROM rows_ GROUP BY nature
UNION ALL SELECT nature || ' / amount', CAST(sum(amount) AS BIGINT) FROM rows_ GROUP BY nature"""

COUNTERS = f"""{TICKETS}, {ITEMS},
sold AS (SELECT * FROM tickets WHERE type IN ('F', 'P') AND trim(ticket_no) <> ''),
n AS (SELECT (SELECT count(*) FROM lineitem) AS items, (SELECT count(*) FROM orders) AS orders,
             (SELECT count(*) FROM sold) AS sold,
             (SELECT count(DISTINCT period) FROM items) AS report,
             (SELECT count(DISTINCT period) FROM sold) AS journal,
             (SELECT count(DISTINCT period) FROM (SELECT period FROM items UNION SELECT period FROM sold)) AS all_months),
counters AS (
  SELECT 'lineitem' AS output, 0 AS n_read, 0 AS n_selected, items AS n_written FROM n
  UNION ALL SELECT 'orders', 0, 0, orders FROM n
  UNION ALL SELECT 'report_monthly', items, items, report FROM n
  UNION ALL SELECT 'journal_monthly', orders, sold, journal FROM n
  UNION ALL SELECT 'reconciled', report + journal, report + journal, all_months FROM n)"""

ORACLES["lineage"] = f"""
WITH {COUNTERS}
SELECT output, {big('n_read', 'n_read')}, {big('n_selected', 'n_selected')},
       {big('n_written', 'n_written')} FROM counters"""

ORACLES["check_lineage"] = f"""
WITH {COUNTERS}
SELECT output, {big('n_read + 1', 'n_read')}, {big('n_read', 'n_available')} FROM counters
WHERE output = 'journal_monthly'"""

ORACLES["run_report"] = f"""
WITH {COUNTERS},
t AS (SELECT CAST(sum(amount) AS BIGINT) AS ttc, CAST(sum((amount * 5) // 6) AS BIGINT) AS ht FROM items)
SELECT output,
       CASE output WHEN 'report_monthly' THEN 'lineitem' WHEN 'journal_monthly' THEN 'orders'
                   WHEN 'reconciled' THEN 'journal_monthly; report_monthly' ELSE '' END AS sources,
       {big('n_read', 'n_read')}, {big('n_selected', 'n_selected')}, {big('n_written', 'n_written')},
       CASE WHEN output = 'report_monthly'
            THEN 'total_ht: ' || CAST(ht // 100 AS VARCHAR) || ',' || lpad(CAST(ht % 100 AS VARCHAR), 2, '0')
              || '; ttc: ' || CAST(ttc // 100 AS VARCHAR) || ',' || lpad(CAST(ttc % 100 AS VARCHAR), 2, '0')
            ELSE '' END AS totals
FROM counters, t"""

ORACLES["file_roundtrip"] = f"""
WITH {TICKETS}
SELECT 'SHOP=' || shop AS shop, internal_no,
       CASE WHEN means = '5' THEN 'X' WHEN type = 'P' THEN '_R_F' ELSE 'REG' END AS type,
       strftime(ticket_date, '%Y-%m-%d') AS ticket_date,
       CASE WHEN means = '5' THEN NULL WHEN type = 'P' THEN -ttc ELSE ttc END AS ttc
FROM tickets"""

ORACLES["csv_roundtrip"] = f"""
WITH {TICKETS}
SELECT shop, CAST(year AS INTEGER) AS year, internal_no, ticket_no,
       strftime(ticket_date, '%Y-%m-%d') AS ticket_date, ticket_time, ht1, vat1, ttc, pay_card
FROM tickets WHERE type IN ('F', 'P') AND trim(ticket_no) <> ''"""
