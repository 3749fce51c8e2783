"""DuckDB statements that the queries must equal.

Each statement derives the layers from ``events`` itself and then states the result in its own way:
self joins and correlated subqueries where the Spark side uses windows, whole-number arithmetic for
averages and ratios. Money is returned as DOUBLE.
"""

from __future__ import annotations

_CLEANED = """
WITH typed AS (
    SELECT event_id AS e, ts, value::DECIMAL(18,2) AS v,
           CASE event_type WHEN 'signup' THEN 'deposit' WHEN 'click' THEN 'withdrawal'
                WHEN 'purchase' THEN 'payment' WHEN 'view' THEN 'transfer'
                WHEN 'error' THEN 'fee' END AS kind
    FROM events
), repeated AS (
    FROM typed UNION ALL FROM typed WHERE e % 197 = 29
), bronze AS (
    SELECT CASE WHEN e % 211 <> 13 THEN 'T' || lpad(e::VARCHAR, 10, '0') END AS transaction_id,
           CASE WHEN e % 223 <> 17 THEN ts END AS booked_at,
           (CASE WHEN e % 229 = 23 THEN NULL
                 WHEN e % 233 = 31 THEN 0
                 WHEN e % 239 = 37 THEN 9999999.99
                 WHEN kind = 'deposit' OR kind = 'transfer' AND e % 2 = 0 THEN v
                 ELSE -v END)::DECIMAL(18,2) AS amount,
           CASE WHEN e % 227 = 19 THEN NULL WHEN e % 53 = 5 THEN upper(kind) ELSE kind END
               AS transaction_type,
           ts::DATE AS booked_date
    FROM repeated
), complete AS (
    SELECT *, row_number() OVER (
        PARTITION BY transaction_id
        ORDER BY booked_at DESC, amount DESC NULLS LAST, transaction_type, booked_date DESC) AS place
    FROM bronze
    WHERE transaction_id IS NOT NULL AND booked_at IS NOT NULL AND transaction_type IS NOT NULL
), silver_clean AS (
    SELECT transaction_id, booked_at, amount, lower(trim(transaction_type)) AS transaction_type,
           coalesce(amount <> 0 AND abs(amount) <= 1000000, false) AS amount_valid, booked_date
    FROM complete WHERE place = 1
), gold_clean AS (
    SELECT transaction_type, sum(amount)::DECIMAL(18,2) AS daily_total,
           count(*) AS record_count, booked_date
    FROM silver_clean WHERE amount_valid
    GROUP BY ALL
"""

_FAULTY = """), silver AS (
    SELECT * REPLACE (
        (CASE WHEN substr(transaction_id, 2)::BIGINT % 251 = 43 THEN NULL
              WHEN substr(transaction_id, 2)::BIGINT % 241 = 41 THEN amount + 0.01
              ELSE amount END)::DECIMAL(18,2) AS amount)
    FROM silver_clean WHERE booked_date <> DATE '2024-01-20'
), gold AS (
    SELECT transaction_type,
           (daily_total + CASE WHEN booked_date = DATE '2024-01-05'
                                AND transaction_type = 'deposit' THEN 1 ELSE 0 END
           )::DECIMAL(18,2) AS daily_total, record_count, booked_date
    FROM gold_clean WHERE booked_date NOT IN (DATE '2024-01-10', DATE '2024-01-20')
    UNION ALL
    SELECT 'deposit', 100.00, 1, DATE '2024-02-01'
"""

# Queries on one layer take it as it was cleaned, with all its dates.
_WHOLE = """), silver AS (
    FROM silver_clean
), gold AS (
    FROM gold_clean
"""

_VALID = """), valid AS (
    FROM silver WHERE amount_valid
)
"""

_ON_WHOLE_LAYERS = """
    silver_partitions gold_partitions silver_sample silver_validity_by_day silver_type_breakdown silver_flagged silver_running_balance
    silver_percentiles silver_daily_totals silver_weekly silver_top3_per_day silver_liquidity_ratio
    carried_running_balance carried_day_over_day carried_gold_cumulative
    silver_percentiles_approx silver_day_over_day lifetime_balance daily_pivot gold_sample gold_by_day gold_by_type gold_cumulative gold_weekly
""".split()


def _half_up(numerator: str, denominator: str) -> str:
    """Whole-number quotient, halves away from zero; the denominator is positive or NULL."""
    return (
        f"(sign({numerator}) * ((2 * abs({numerator}) + ({denominator})) // (2 * ({denominator}))))"
    )


def _cents(total: str) -> str:
    return f"(({total}) * 100)::HUGEINT"


def _mean(column: str) -> str:
    return f"({_half_up(_cents(f'sum({column})'), f'nullif(count({column}), 0)')} / 100)::DOUBLE"


def _partitions(layer: str) -> str:
    return f"""SELECT DISTINCT booked_date, 'booked_date=' || booked_date::VARCHAR AS directory
               FROM {layer}"""


def _first_twenty(layer: str) -> str:
    return f"""SELECT * REPLACE (amount::DOUBLE AS amount) FROM {layer}
               ORDER BY booked_at NULLS LAST, transaction_id NULLS LAST, amount NULLS LAST,
                        transaction_type NULLS LAST, booked_date
               LIMIT 20"""


_INFLOW = "coalesce(sum(amount) FILTER (amount > 0), 0)"
_OUTFLOW = "coalesce(sum(amount) FILTER (amount < 0), 0)"

_COVERAGE = f"""
SELECT {{by}}.booked_date AS booked_date,
       count(silver.transaction_id) AS silver_row_count,
       count(bronze.transaction_id) AS bronze_row_count,
       ({_half_up('1000 * count(silver.transaction_id)',
                  'nullif(count(bronze.transaction_id), 0)')} / 10)::DOUBLE AS silver_coverage_pct
FROM bronze LEFT JOIN silver USING (transaction_id, booked_date)
GROUP BY 1"""

_RULE = "SELECT '{layer}' AS layer, '{rule}' AS rule, ({failing})::BIGINT AS failing"
_RULES = {
    ("bronze", "id_present"): "SELECT count(*) FROM bronze WHERE transaction_id IS NULL",
    ("bronze", "time_present"): "SELECT count(*) FROM bronze WHERE booked_at IS NULL",
    ("bronze", "amount_present"): "SELECT count(*) FROM bronze WHERE amount IS NULL",
    ("bronze", "type_present"): "SELECT count(*) FROM bronze WHERE transaction_type IS NULL",
    ("bronze", "type_normalized"): """SELECT count(*) FROM bronze
        WHERE transaction_type <> lower(trim(transaction_type))""",
    ("bronze", "id_unique"): """SELECT coalesce(sum(n - 1), 0) FROM (
        SELECT count(*) AS n FROM bronze WHERE transaction_id IS NOT NULL GROUP BY transaction_id)""",
    ("silver", "id_present"): "SELECT count(*) FROM silver WHERE transaction_id IS NULL",
    ("silver", "type_known"): """SELECT count(*) FROM silver WHERE transaction_type
        NOT IN ('deposit', 'withdrawal', 'payment', 'transfer', 'fee')""",
    ("silver", "valid_amount_present"): "SELECT count(*) FROM valid WHERE amount IS NULL",
    ("silver", "amount_valid"): "SELECT count(*) FROM silver WHERE NOT amount_valid",
    ("silver", "id_unique"): """SELECT coalesce(sum(n - 1), 0) FROM (
        SELECT count(*) AS n FROM silver GROUP BY transaction_id)""",
    ("gold", "total_present"): "SELECT count(*) FROM gold WHERE daily_total IS NULL",
    ("gold", "count_positive"): "SELECT count(*) FROM gold WHERE record_count <= 0",
    ("bronze_silver", "id_in_silver"): """SELECT count(*) FROM bronze
        WHERE transaction_id NOT IN (SELECT transaction_id FROM silver)""",
    ("bronze_silver", "amount_kept"): """SELECT count(*) FROM bronze b JOIN silver s
        USING (transaction_id) WHERE b.amount IS DISTINCT FROM s.amount""",
    ("bronze_silver", "date_in_silver"): """SELECT count(DISTINCT booked_date) FROM bronze
        WHERE booked_date NOT IN (SELECT booked_date FROM silver)""",
    ("silver_gold", "total_matches"): """SELECT count(*) FROM (
        SELECT booked_date, transaction_type, sum(amount) AS total FROM valid GROUP BY ALL) s
        FULL JOIN gold g USING (booked_date, transaction_type)
        WHERE coalesce(s.total, 0) <> coalesce(g.daily_total, 0)""",
    ("silver_gold", "count_matches"): """SELECT count(*) FROM (
        SELECT booked_date, transaction_type, count(*) AS n FROM valid GROUP BY ALL) s
        FULL JOIN gold g USING (booked_date, transaction_type)
        WHERE s.n IS DISTINCT FROM g.record_count""",
    ("silver_gold", "date_in_gold"): """SELECT count(DISTINCT booked_date) FROM silver
        WHERE booked_date NOT IN (SELECT booked_date FROM gold)""",
}

_BODIES: dict[str, str] = {
    "bronze_partitions": _partitions("bronze"),
    "silver_partitions": _partitions("silver"),
    "gold_partitions": _partitions("gold"),
    "bronze_sample": _first_twenty("bronze"),
    "bronze_volume_by_day": "SELECT booked_date, count(*) AS row_count FROM bronze GROUP BY ALL",
    "bronze_type_distribution": f"""
        SELECT transaction_type, count(*) AS txn_count, sum(amount)::DOUBLE AS total_amount,
               {_mean('amount')} AS avg_amount, min(amount)::DOUBLE AS min_amount,
               max(amount)::DOUBLE AS max_amount
        FROM bronze GROUP BY ALL""",
    "bronze_null_audit": """
        SELECT count(*) AS total_rows, count(*) - count(transaction_id) AS null_txn_id,
               count(*) - count(booked_at) AS null_booked_at,
               count(*) - count(amount) AS null_amount,
               count(*) - count(transaction_type) AS null_txn_type,
               (SELECT count(*) FROM (SELECT DISTINCT transaction_id FROM bronze
                                      WHERE transaction_id IS NOT NULL)) AS distinct_txn_ids
        FROM bronze""",
    "bronze_duplicates": """
        SELECT * FROM (SELECT transaction_id, count(*) AS occurrences FROM bronze GROUP BY ALL)
        WHERE occurrences > 1""",
    "bronze_cash_flow": f"""
        SELECT booked_date, {_INFLOW}::DOUBLE AS total_inflows, {_OUTFLOW}::DOUBLE AS total_outflows,
               sum(amount)::DOUBLE AS net_flow, count(*) AS txn_count
        FROM bronze GROUP BY ALL""",
    "silver_sample": _first_twenty("silver"),
    "silver_validity_by_day": """
        SELECT booked_date, count(*) AS row_count,
               sum(amount_valid::INT)::BIGINT AS valid_amount_count,
               sum((NOT amount_valid)::INT)::BIGINT AS invalid_amount_count
        FROM silver GROUP BY ALL""",
    "silver_type_breakdown": f"""
        SELECT transaction_type, count(*) AS txn_count, sum(amount)::DOUBLE AS total_amount,
               {_mean('amount')} AS avg_amount
        FROM valid GROUP BY ALL""",
    "silver_flagged": """
        SELECT * REPLACE (amount::DOUBLE AS amount) FROM silver WHERE NOT amount_valid""",
    "silver_running_balance": """
        SELECT d.booked_date, any_value(d.net)::DOUBLE AS daily_net,
               sum(p.net)::DOUBLE AS running_balance
        FROM (SELECT booked_date, sum(amount) AS net FROM valid GROUP BY ALL) d
        JOIN (SELECT booked_date, sum(amount) AS net FROM valid GROUP BY ALL) p
          ON p.booked_date <= d.booked_date
        GROUP BY d.booked_date""",
    "silver_percentiles": """
        SELECT transaction_type,
               quantile_disc(amount, 0.25)::DOUBLE AS p25,
               quantile_disc(amount, 0.50)::DOUBLE AS median,
               quantile_disc(amount, 0.75)::DOUBLE AS p75,
               quantile_disc(amount, 0.95)::DOUBLE AS p95
        FROM valid GROUP BY ALL""",
    "silver_percentiles_approx": """
        SELECT transaction_type,
               quantile_disc(amount, 0.25)::DOUBLE AS p25,
               quantile_disc(amount, 0.50)::DOUBLE AS median,
               quantile_disc(amount, 0.75)::DOUBLE AS p75,
               quantile_disc(amount, 0.95)::DOUBLE AS p95
        FROM valid GROUP BY ALL""",
    "recon_layer_counts": """
        SELECT booked_date, count(transaction_id) AS bronze_count,
               count(transaction_id) FILTER (held) AS silver_count,
               count(transaction_id) FILTER (NOT held) AS dropped_in_silver
        FROM (SELECT DISTINCT booked_date, transaction_id,
                     coalesce(transaction_id IN (SELECT transaction_id FROM silver), false) AS held
              FROM bronze)
        GROUP BY ALL""",
    "recon_missing_in_silver": """
        SELECT * REPLACE (amount::DOUBLE AS amount)
        FROM bronze ANTI JOIN silver USING (transaction_id)""",
    "recon_amount_discrepancy": """
        SELECT transaction_id, b.booked_date, b.amount::DOUBLE AS bronze_amount,
               s.amount::DOUBLE AS silver_amount, (b.amount - s.amount)::DOUBLE AS delta
        FROM bronze b JOIN silver s USING (transaction_id)
        WHERE b.amount IS DISTINCT FROM s.amount""",
    "recon_type_mismatch": """
        SELECT b.transaction_type AS bronze_type, s.transaction_type AS silver_type,
               count(*) AS mismatch_count
        FROM bronze b JOIN silver s USING (transaction_id)
        WHERE b.transaction_type <> s.transaction_type
        GROUP BY ALL""",
    "recon_dates_bronze_not_silver": """
        SELECT booked_date FROM bronze EXCEPT SELECT booked_date FROM silver""",
    "gold_sample": """
        SELECT * REPLACE (daily_total::DOUBLE AS daily_total) FROM gold
        ORDER BY booked_date, transaction_type LIMIT 20""",
    "gold_by_day": """
        SELECT booked_date, count(*) AS type_count, sum(daily_total)::DOUBLE AS total_amount,
               sum(record_count)::BIGINT AS total_records
        FROM gold GROUP BY ALL""",
    "gold_by_type": """
        SELECT transaction_type, sum(daily_total)::DOUBLE AS grand_total,
               sum(record_count)::BIGINT AS total_records,
               count(DISTINCT booked_date) AS days_present
        FROM gold GROUP BY ALL""",
    "recon_silver_gold": """
        SELECT booked_date, transaction_type,
               max(total) FILTER (side = 's')::DOUBLE AS silver_total,
               max(total) FILTER (side = 'g')::DOUBLE AS gold_total,
               max(n) FILTER (side = 's') AS silver_count,
               max(n) FILTER (side = 'g') AS gold_count,
               sum(CASE side WHEN 's' THEN total ELSE -total END)::DOUBLE AS total_delta
        FROM (SELECT 's' AS side, booked_date, transaction_type, sum(amount) AS total,
                     count(*) AS n FROM valid GROUP BY ALL
              UNION ALL
              SELECT 'g', booked_date, transaction_type, daily_total, record_count FROM gold)
        GROUP BY ALL""",
    "recon_dates_silver_not_gold": """
        SELECT booked_date FROM silver EXCEPT SELECT booked_date FROM gold""",
    "gold_cumulative": """
        SELECT d.booked_date, d.transaction_type, d.daily_total::DOUBLE AS daily_total,
               (SELECT sum(p.daily_total) FROM gold p
                WHERE p.transaction_type = d.transaction_type
                  AND p.booked_date <= d.booked_date)::DOUBLE AS cumulative_total
        FROM gold d""",
    "gold_weekly": """
        SELECT booked_date - (isodow(booked_date) - 1)::INT AS week_start, transaction_type,
               sum(daily_total)::DOUBLE AS weekly_total, sum(record_count)::BIGINT AS weekly_records
        FROM gold GROUP BY ALL""",
    "silver_daily_totals": """
        SELECT booked_date, transaction_type, sum(amount)::DOUBLE AS daily_total,
               count(*) AS record_count
        FROM valid GROUP BY ALL""",
    "silver_weekly": """
        SELECT booked_date - (isodow(booked_date) - 1)::INT AS week_start, transaction_type,
               sum(amount)::DOUBLE AS weekly_net, count(*) AS txn_count
        FROM valid GROUP BY ALL""",
    "silver_top3_per_day": """
        SELECT booked_date, transaction_id, transaction_type, amount::DOUBLE AS amount,
               1 + larger AS rnk
        FROM (SELECT *, (SELECT count(*) FROM valid o
                         WHERE o.booked_date = v.booked_date AND abs(o.amount) > abs(v.amount)) AS larger
              FROM valid v)
        WHERE larger < 3""",
    "silver_liquidity_ratio": f"""
        SELECT booked_date, money_in::DOUBLE AS deposits, money_out::DOUBLE AS withdrawals,
               ({_half_up('100 * ' + _cents('money_in'), f'nullif({_cents("money_out")}, 0)')}
                / 100)::DOUBLE AS deposit_withdrawal_ratio
        FROM (SELECT booked_date, {_INFLOW} AS money_in, -{_OUTFLOW} AS money_out
              FROM valid GROUP BY ALL)""",
    "silver_day_over_day": """
        SELECT d.booked_date, d.net::DOUBLE AS daily_net,
               (d.net - p.net)::DOUBLE AS day_over_day_delta
        FROM (SELECT booked_date, sum(amount) AS net FROM valid GROUP BY ALL) d
        ASOF LEFT JOIN (SELECT booked_date, sum(amount) AS net FROM valid GROUP BY ALL) p
          ON d.booked_date > p.booked_date""",
    "medallion_journey": """
        SELECT b.transaction_id, b.booked_date, b.transaction_type,
               b.amount::DOUBLE AS bronze_amount, s.amount_valid AS silver_valid,
               s.amount::DOUBLE AS silver_amount,
               (sum(s.amount) OVER (PARTITION BY b.booked_date, b.transaction_type))::DOUBLE
                   AS daily_type_total
        FROM bronze b LEFT JOIN silver s ON s.transaction_id = b.transaction_id
        ORDER BY b.booked_date NULLS LAST, b.transaction_type NULLS LAST,
                 b.transaction_id NULLS LAST, b.amount NULLS LAST, s.amount NULLS LAST,
                 s.amount_valid NULLS LAST
        LIMIT 50""",
    "lifetime_balance": """
        SELECT transaction_type, sum(amount)::DOUBLE AS lifetime_net, count(*) AS total_txn_count,
               min(booked_date) AS first_txn_date, max(booked_date) AS last_txn_date
        FROM valid GROUP BY ALL""",
    "daily_pivot": """
        SELECT booked_date, deposit::DOUBLE AS deposit, withdrawal::DOUBLE AS withdrawal,
               payment::DOUBLE AS payment, transfer::DOUBLE AS transfer, fee::DOUBLE AS fee,
               total::DOUBLE AS total
        FROM (FROM (SELECT booked_date, transaction_type, amount FROM valid)
              PIVOT (sum(amount) FOR transaction_type IN
                     ('deposit', 'withdrawal', 'payment', 'transfer', 'fee')
                     GROUP BY booked_date))
        JOIN (SELECT booked_date, sum(amount) AS total FROM valid GROUP BY ALL)
          USING (booked_date)""",
    "silver_coverage": _COVERAGE.format(by="silver"),
    "silver_coverage_by_bronze_date": _COVERAGE.format(by="bronze"),
    "freshness": """
        SELECT layer, max(booked_date) AS last_partition
        FROM (SELECT 'bronze' AS layer, booked_date FROM bronze
              UNION ALL SELECT 'silver', booked_date FROM silver
              UNION ALL SELECT 'gold', booked_date FROM gold)
        GROUP BY ALL""",
    "matched_by_type": """
        SELECT b.transaction_type AS trans_type, count(*) AS total_transactions
        FROM bronze b JOIN silver s USING (transaction_id)
        GROUP BY ALL""",
    "matched_by_type_where": """
        SELECT b.transaction_type AS trans_type, count(*) AS total_transactions
        FROM bronze b JOIN silver s USING (transaction_id) WHERE b.amount > 0
        GROUP BY ALL""",
    "bronze_ingest": "SELECT * REPLACE (amount::DOUBLE AS amount) FROM bronze",
    "silver_clean": "SELECT * REPLACE (amount::DOUBLE AS amount) FROM silver_clean",
    "silver_rejects": """
        SELECT transaction_id, booked_at, amount::DOUBLE AS amount, transaction_type, reason,
               count(*) AS copies, booked_date
        FROM (SELECT * EXCLUDE (place), 'duplicate' AS reason FROM complete WHERE place > 1
              UNION ALL
              SELECT *, CASE WHEN transaction_id IS NULL THEN 'missing_id'
                             WHEN booked_at IS NULL THEN 'missing_time'
                             ELSE 'missing_type' END
              FROM bronze
              WHERE transaction_id IS NULL OR booked_at IS NULL OR transaction_type IS NULL)
        GROUP BY ALL""",
    "gold_build": "SELECT * REPLACE (daily_total::DOUBLE AS daily_total) FROM gold_clean",
    "layer_round_trip": "SELECT * REPLACE (amount::DOUBLE AS amount) FROM silver_clean",
    "arrivals_bronze": "SELECT * REPLACE (amount::DOUBLE AS amount) FROM bronze",
    "published_corrections": "SELECT * REPLACE (amount::DOUBLE AS amount) FROM silver_clean",
    "silver_by_name": """SELECT * REPLACE (amount::DOUBLE AS amount),
        'booked_date=' || booked_date::VARCHAR AS directory FROM silver_clean""",
    "bitmap_weekly_ids": """
        SELECT date_trunc('week', booked_date)::DATE AS week_start,
               count(DISTINCT transaction_id) AS distinct_ids
        FROM bronze GROUP BY ALL""",
    # Sketches promise ranks, not values: every percentile has to keep the promise.
    "merged_percentile_ranks": """
        SELECT transaction_type, count(amount) AS amounts,
               true AS p25, true AS median, true AS p75, true AS p95
        FROM silver_clean WHERE amount_valid GROUP BY ALL""",
    "silver_incremental": "SELECT * REPLACE (amount::DOUBLE AS amount) FROM silver_clean",
    "gold_incremental": "SELECT * REPLACE (daily_total::DOUBLE AS daily_total) FROM gold_clean",
    "silver_drift": """
        SELECT * FROM (WITH digits AS (
            SELECT *, CAST(CAST(abs(amount * 100) AS BIGINT) AS VARCHAR) AS d FROM silver_clean
            WHERE amount IS NOT NULL AND transaction_type IS NOT NULL AND booked_date IS NOT NULL),
        counts AS (
            SELECT transaction_type, booked_date, count(*) AS n,
                   sign(amount)::INT * (length(d) * 1000 + rpad(substr(d, 1, 3), 3, '0')::INT) AS bucket
            FROM digits GROUP BY ALL),
        totals AS (
            SELECT transaction_type, booked_date, sum(n) AS nb FROM counts GROUP BY ALL),
        pairs AS (
            SELECT *, lag(booked_date) OVER w AS previous_date, lag(nb) OVER w AS na FROM totals
            WINDOW w AS (PARTITION BY transaction_type ORDER BY booked_date)
            QUALIFY previous_date IS NOT NULL),
        both_dates AS (
            SELECT p.transaction_type, p.booked_date, previous_date, na, nb, bucket,
                   sum(CASE WHEN c.booked_date = previous_date THEN n ELSE 0 END) AS a,
                   sum(CASE WHEN c.booked_date = p.booked_date THEN n ELSE 0 END) AS b
            FROM pairs p JOIN counts c
              ON c.transaction_type = p.transaction_type AND c.booked_date IN (p.booked_date, previous_date)
            GROUP BY ALL),
        cumulated AS (
            SELECT *, sum(a) OVER w AS ca, sum(b) OVER w AS cb FROM both_dates
            WINDOW w AS (PARTITION BY transaction_type, booked_date ORDER BY bucket)),
        ks AS (
            SELECT transaction_type, booked_date, previous_date, na::BIGINT AS previous_count,
                   nb::BIGINT AS record_count,
                   round(max(abs(ca::DOUBLE / na::DOUBLE - cb::DOUBLE / nb::DOUBLE)), 9) AS ks,
                   round(sqrt(-ln(0.0005::DOUBLE) / 2) * sqrt((na + nb)::DOUBLE / (na::DOUBLE * nb::DOUBLE)), 9) AS ks_limit
            FROM cumulated GROUP BY transaction_type, booked_date, previous_date, na, nb),
        bins AS (
            SELECT transaction_type, booked_date, na, nb, sign(bucket) * floor(abs(bucket) / 100.0) AS bin,
                   sum(a) + 0.5::DOUBLE AS a, sum(b) + 0.5::DOUBLE AS b
            FROM both_dates GROUP BY ALL),
        shares AS (
            SELECT transaction_type, booked_date,
                   a / (na + 0.5::DOUBLE * count(*) OVER w) AS p, b / (nb + 0.5::DOUBLE * count(*) OVER w) AS q
            FROM bins WINDOW w AS (PARTITION BY transaction_type, booked_date)),
        psi AS (
            SELECT transaction_type, booked_date, round(sum((q - p) * ln(q / p)), 6) AS psi
            FROM shares GROUP BY ALL)
        SELECT ks.*, psi, ks > ks_limit AND psi >= 0.2 AS drifted
        FROM ks JOIN psi USING (transaction_type, booked_date))
        ORDER BY transaction_type, booked_date""",
    "clustered_layer": "SELECT * REPLACE (amount::DOUBLE AS amount) FROM bronze",
    "compaction": "SELECT * REPLACE (amount::DOUBLE AS amount) FROM bronze",
    "quality_report": "SELECT *, failing = 0 AS passed FROM (\n"
    + "\nUNION ALL\n".join(
        _RULE.format(layer=layer, rule=rule, failing=failing)
        for (layer, rule), failing in _RULES.items()
    )
    + ")",
}

# Queries that must give what another one does, from layers that are stored in another way.
_ALIKE = {
    "colocated_layer_counts": "recon_layer_counts",
    "colocated_missing_in_silver": "recon_missing_in_silver",
    "colocated_amount_discrepancy": "recon_amount_discrepancy",
    "colocated_type_mismatch": "recon_type_mismatch",
    "colocated_matched_by_type": "matched_by_type",
    "digest_amount_discrepancy": "recon_amount_discrepancy",
    "digest_silver_gold": "recon_silver_gold",
    "bitmap_layer_counts": "recon_layer_counts",
    "carried_running_balance": "silver_running_balance",
    "carried_day_over_day": "silver_day_over_day",
    "carried_gold_cumulative": "gold_cumulative",
}
_BODIES |= {name: _BODIES[other] for name, other in _ALIKE.items()}


def statements() -> dict[str, str]:
    return {
        name: _CLEANED + (_WHOLE if name in _ON_WHOLE_LAYERS else _FAULTY) + _VALID + body
        for name, body in _BODIES.items()
    }
