"""DuckDB SQL for the binding and derivations (oracle side).

An independent SQL statement of the same rules as
:mod:`ledgerloom.sources.binding` and :mod:`ledgerloom.operators.derive`,
over the pre-registered test-warehouse views. Each entry is one CTE body;
:mod:`ledgerloom.plans.oracle` assembles the ones a query needs.

Engine notes: DuckDB divides decimals into DOUBLE, so exact amounts are
computed by multiplying with decimal literals; ``date_trunc`` returns a
TIMESTAMP, so it is cast back to DATE.
"""

PAD3 = "lpad(CAST({x} AS VARCHAR), 3, '0')"

CTES: dict[str, str] = {}

CTES["geo"] = """
SELECT n.n_nationkey, n.n_name, r.r_regionkey, r.r_name
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey"""

CTES["raw_dim_country"] = """
SELECT r_name AS country_code, substr(r_name, 1, 2) AS country_code_iso2, r_name AS country_name,
       'C' || lpad(CAST(r_regionkey AS VARCHAR), 3, '0') AS sap_company_code,
       substr(r_name, 1, 3) AS base_currency, 'USD' AS group_currency, 'VAT' AS tax_system,
       CAST(r_regionkey + 5 AS DECIMAL(8,4)) AS tax_rate_standard, 12 AS fiscal_year_end_month,
       'UTC' AS timezone, 1 AS settlement_lag_days,
       CAST(20 + 10 * r_regionkey AS DECIMAL(18,2)) AS variance_threshold_t2,
       CAST(100 + 50 * r_regionkey AS DECIMAL(18,2)) AS variance_threshold_t3,
       CAST(500 + 250 * r_regionkey AS DECIMAL(18,2)) AS variance_threshold_t4,
       'REG-' || CAST(r_regionkey AS VARCHAR) AS regulatory_body,
       'DPL-' || CAST(r_regionkey AS VARCHAR) AS data_privacy_law,
       'PAYNOW, NETS' AS dominant_ewallet,
       'RAIL-' || CAST(r_regionkey AS VARCHAR) AS bank_transfer_rail,
       r_regionkey <> 4 AS is_active
FROM region"""

CTES["raw_dim_store"] = """
SELECT 'ST-' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS store_id, r_name AS country_code,
       'Store ' || n_name AS store_name, n_name || ' Mall' AS mall_name, n_name AS city, r_name AS state,
       CASE WHEN n_nationkey < 5 THEN 'FLAGSHIP' ELSE 'STANDARD' END AS store_type,
       'PC-' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS sap_profit_center,
       'CC-' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS sap_cost_center,
       'ACCT-' || lpad(CAST(r_regionkey AS VARCHAR), 3, '0') AS bank_account,
       'BANK' || CAST(r_regionkey AS VARCHAR) AS bank_code,
       'MID-' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS mas_merchant_id,
       'TAX-' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS tax_registration,
       'MGR-' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS store_manager,
       CAST(DATE '1990-01-01' + CAST(n_nationkey * 100 AS INTEGER) AS DATE) AS open_date,
       TRUE AS is_active, CAST(2000 + 100 * n_nationkey AS INTEGER) AS floor_area_sqft,
       CAST(2 + n_nationkey % 5 AS INTEGER) AS num_terminals
FROM geo"""

CTES["tender_map"] = """
SELECT * FROM (VALUES (1, 'VISA', 'Visa Credit / Debit', 'CARD', 1),
                      (2, 'MASTERCARD', 'Mastercard Credit / Debit', 'CARD', 1),
                      (3, 'AMEX', 'American Express', 'CARD', 2),
                      (4, 'NETS', 'NETS Debit', 'CARD', 1),
                      (5, 'PAYNOW', 'PayNow / FAST', 'EWALLET', 0)) AS t(t, code, tname, cat, lag)"""

CTES["raw_dim_tender_type"] = """
SELECT m.code AS tender_code, 'BOTH' AS country_code, m.tname AS tender_name, m.cat AS tender_category,
       '00111000' || lpad(CAST(p.t AS VARCHAR), 2, '0') AS sap_gl_account,
       CAST(m.lag AS INTEGER) AS settlement_lag_days, m.cat = 'CARD' AS is_card, m.cat = 'EWALLET' AS is_ewallet,
       CAST(p.t * 0.5 AS DECIMAL(8,4)) AS interchange_rate_pct, TRUE AS is_active,
       'Priority ' || CAST(p.t AS VARCHAR) AS notes
FROM (SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS t FROM orders) p
JOIN tender_map m ON m.t = p.t"""

CTES["raw_dim_root_cause"] = """
SELECT * FROM (VALUES
 ('RC-001', 'SYSTEM', 'Batch Job', 'SAP batch posting job failed or timed out', 'IT-SAP', 4, FALSE, 0),
 ('RC-002', 'SYSTEM', 'Integration', 'POS-SAP integration feed not received (middleware timeout)', 'IT-Middleware', 6, FALSE, 0),
 ('RC-003', 'CONFIG', 'Promo Mapping', 'Promotion code not configured in SAP pricing conditions', 'IT-SAP', 8, TRUE, 0),
 ('RC-004', 'PROCESS', 'Manual Entry', 'Manual SAP posting entered with incorrect amount', 'Finance', 2, FALSE, 0),
 ('RC-005', 'DATA', 'Duplicate', 'Duplicate POS transaction transmitted to SAP', 'IT-POS', 3, FALSE, 0),
 ('RC-006', 'PROCESS', 'Return', 'POS return not correctly reversed in SAP', 'Finance', 2, FALSE, 0),
 ('RC-007', 'DATA', 'Rounding', 'Rounding difference between POS (2dp) and SAP (2dp) due to tax calc', 'IT-SAP', 1, TRUE, 0),
 ('RC-008', 'PROCESS', 'Period', 'SAP posting in wrong fiscal period (prior period close issue)', 'Finance', 4, FALSE, 0),
 ('RC-009', 'PAYMENT', 'Settlement Lag', 'Card/e-wallet settlement received in bank later than expected', 'Treasury', 24, FALSE, 0),
 ('RC-010', 'PAYMENT', 'Interchange', 'Interchange fee deducted differs from contracted rate', 'Treasury', 48, TRUE, 0),
 ('RC-011', 'PAYMENT', 'Chargeback', 'Customer chargeback deducted from settlement batch', 'Finance', 72, FALSE, 0),
 ('RC-012', 'DATA', 'Data Quality', 'Source data quality issue — null, invalid or out-of-range value', 'IT-POS', 4, FALSE, 0),
 ('RC-013', 'CONFIG', 'Tax Code', 'Wrong tax code applied — SST/GST rate mismatch', 'IT-SAP', 4, TRUE, 0),
 ('RC-014', 'PAYMENT', 'Missing Credit', 'Bank statement credit not received — bank cut-off or processing delay', 'Treasury', 48, FALSE, 0),
 ('RC-015', 'SYSTEM', 'FX Conversion', 'Cross-border card FX conversion error (tourist spend in SG)', 'IT-SAP', 8, FALSE, 0)
) AS t(root_cause_code, category, subcategory, description, responsible_team, typical_resolution_hrs,
       is_systemic, occurrence_count)"""

CTES["hdr_base"] = """
SELECT o.o_orderkey AS k, CAST(o.o_totalprice AS DECIMAL(18,2)) AS g, o.o_orderdate, o.o_orderpriority,
       c.c_nationkey, g2.r_regionkey, g2.r_name,
       CASE WHEN o.o_orderkey % 50 = 1 THEN 'VOID' WHEN o.o_orderkey % 20 = 3 THEN 'RETURN' ELSE 'SALE' END AS txn_type,
       CASE WHEN o.o_orderkey % 97 = 5 THEN 'SAP_BATCH_FAIL'
            WHEN o.o_orderkey % 33 = 4 THEN 'PROMO_UNMAPPED'
            WHEN o.o_orderkey % 125 = 6 THEN 'DUPLICATE_TXN'
            WHEN o.o_orderkey % 500 = 8 THEN 'WRONG_PERIOD'
            WHEN o.o_orderkey % 1000 = 9 THEN 'NULL_STORE'
            WHEN o.o_orderkey % 25 = 7 THEN 'MANUAL_ERROR'
            ELSE 'CLEAN' END AS _dq_flag
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN geo g2 ON c.c_nationkey = g2.n_nationkey"""

CTES["hdr_amounts"] = """
SELECT *,
       CAST(CASE WHEN txn_type = 'RETURN' THEN -g ELSE g END AS DECIMAL(18,2)) AS gross_amount,
       CAST(CASE WHEN _dq_flag = 'PROMO_UNMAPPED' AND txn_type = 'SALE' THEN round(g * 0.10, 2) ELSE 0 END
            AS DECIMAL(18,2)) AS discount_amount,
       'ST-' || lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS st
FROM hdr_base"""

CTES["raw_pos_transaction_header"] = """
SELECT 'TXN-' || CAST(k AS VARCHAR) AS pos_txn_id, r_name AS country_code,
       CASE WHEN _dq_flag = 'NULL_STORE' THEN NULL ELSE st END AS store_id,
       st || '-T' || CAST(k % 4 + 1 AS VARCHAR) AS terminal_id,
       'CSH-' || lpad(CAST(k % 50 AS VARCHAR), 3, '0') AS cashier_id,
       CAST(o_orderdate AS DATE) AS business_date, CAST(o_orderdate AS TIMESTAMP) AS txn_datetime_utc,
       txn_type, 'COMPLETED' AS txn_status, gross_amount, discount_amount,
       CAST(gross_amount - discount_amount AS DECIMAL(18,2)) AS net_amount,
       'TX' || CAST(r_regionkey AS VARCHAR) AS tax_code,
       CAST(round(CAST(gross_amount - discount_amount AS DECIMAL(18,2)) * 0.01 * (r_regionkey + 5), 2)
            AS DECIMAL(18,2)) AS tax_amount_local,
       substr(r_name, 1, 3) AS currency_code,
       CAST(gross_amount - discount_amount AS DECIMAL(18,2)) AS total_tendered,
       CASE WHEN _dq_flag = 'PROMO_UNMAPPED' AND txn_type = 'SALE' THEN 'PROMO-' || CAST(k % 10 AS VARCHAR) END
            AS promo_code,
       'RCPT-' || CAST(k AS VARCHAR) AS receipt_number,
       'C' || lpad(CAST(r_regionkey AS VARCHAR), 3, '0') AS sap_company_code,
       CASE WHEN txn_type <> 'VOID' AND _dq_flag NOT IN ('SAP_BATCH_FAIL', 'DUPLICATE_TXN', 'NULL_STORE')
            THEN CAST(k AS VARCHAR) END AS sap_doc_number,
       CASE WHEN txn_type <> 'VOID' AND _dq_flag NOT IN ('SAP_BATCH_FAIL', 'DUPLICATE_TXN', 'NULL_STORE')
            THEN 'POSTED' ELSE 'FAILED' END AS sap_post_status,
       _dq_flag,
       CASE _dq_flag WHEN 'SAP_BATCH_FAIL' THEN 'SAP batch posting job failed'
                     WHEN 'PROMO_UNMAPPED' THEN 'Promotion not mapped in SAP pricing'
                     WHEN 'DUPLICATE_TXN' THEN 'Transaction transmitted twice'
                     WHEN 'WRONG_PERIOD' THEN 'Posted to prior fiscal period'
                     WHEN 'NULL_STORE' THEN 'Store id missing on transaction'
                     WHEN 'MANUAL_ERROR' THEN 'Manual posting with wrong amount' END AS _dq_description
FROM hdr_amounts"""

CTES["raw_pos_tender"] = """
SELECT 'TND-' || substr(h.pos_txn_id, 5) AS pos_tender_id, h.pos_txn_id, h.country_code,
       m.code AS tender_code, CAST(abs(h.gross_amount) AS DECIMAL(18,2)) AS tender_amount, h.currency_code,
       CASE WHEN m.code = 'PAYNOW' THEN 'PAYNOW' END AS ewallet_provider,
       CASE WHEN m.code = 'PAYNOW' THEN 'PN' || substr(h.pos_txn_id, 5) END AS paynow_ref,
       CAST(NULL AS VARCHAR) AS duitnow_ref,
       CASE WHEN m.code = 'NETS' THEN 'NT' || substr(h.pos_txn_id, 5) END AS nets_ref,
       CASE WHEN m.cat = 'CARD' THEN lpad(CAST(CAST(substr(h.pos_txn_id, 5) AS BIGINT) % 10000 AS VARCHAR), 4, '0') END
            AS card_last4,
       CASE WHEN m.cat = 'CARD' THEN m.code END AS card_type,
       'AP' || lpad(CAST(CAST(substr(h.pos_txn_id, 5) AS BIGINT) % 1000000 AS VARCHAR), 6, '0') AS approval_code,
       'RRN' || substr(h.pos_txn_id, 5) AS rrn,
       'BATCH-' || coalesce(h.store_id, 'NOSTORE') || '-' || m.code || '-' || strftime(h.business_date, '%Y%m%d')
            AS settlement_batch,
       h.business_date, h._dq_flag
FROM raw_pos_transaction_header h
JOIN orders o ON h.pos_txn_id = 'TXN-' || CAST(o.o_orderkey AS VARCHAR)
JOIN tender_map m ON m.t = CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER)
WHERE h.txn_type <> 'VOID'"""

CTES["raw_pos_eod_summary"] = """
SELECT 'EOD-' || h.store_id || '-' || strftime(h.business_date, '%Y%m%d') AS eod_summary_id,
       h.country_code, h.store_id, 'ALL' AS terminal_id, h.business_date,
       h.country_code || '-' || strftime(h.business_date, '%Y-%m') AS fiscal_period_key,
       h.currency_code,
       CAST(sum(h.net_amount) AS DECIMAL(18,2)) AS net_sales,
       CAST(sum(h.tax_amount_local) AS DECIMAL(18,2)) AS tax_collected,
       CAST(0 AS DECIMAL(18,2)) AS cash_variance,
       CAST(coalesce(sum(CASE WHEN t.tender_code = 'PAYNOW' THEN t.tender_amount END), 0) AS DECIMAL(18,2)) AS paynow_total,
       CAST(coalesce(sum(CASE WHEN t.tender_code = 'DUITNOW_MY' THEN t.tender_amount END), 0) AS DECIMAL(18,2)) AS duitnow_total,
       CAST(coalesce(sum(CASE WHEN t.tender_code = 'NETS' THEN t.tender_amount END), 0) AS DECIMAL(18,2)) AS nets_total,
       CASE WHEN max(CASE WHEN h._dq_flag = 'SAP_BATCH_FAIL' THEN 1 ELSE 0 END) = 1 THEN 'FAILED' ELSE 'SUCCESS' END
            AS sap_transfer_status,
       'SUP-' || h.store_id AS supervisor_id,
       CASE WHEN max(CASE WHEN h._dq_flag = 'SAP_BATCH_FAIL' THEN 1 ELSE 0 END) = 1 THEN 'SAP_BATCH_FAIL' ELSE 'CLEAN' END
            AS _dq_flag
FROM raw_pos_transaction_header h
LEFT JOIN raw_pos_tender t ON t.pos_txn_id = h.pos_txn_id
WHERE h.txn_type <> 'VOID' AND h.store_id IS NOT NULL
  AND h._dq_flag NOT IN ('NULL_STORE', 'WRONG_COUNTRY', 'FUTURE_DATE')
GROUP BY h.country_code, h.store_id, h.business_date, h.currency_code"""

CTES["postable"] = """
SELECT h.*,
       CASE WHEN _dq_flag = 'WRONG_PERIOD'
            THEN CAST(CAST(date_trunc('month', business_date - INTERVAL 1 MONTH) AS DATE) + 27 AS DATE)
            ELSE business_date END AS budat_,
       CAST(CASE WHEN _dq_flag = 'PROMO_UNMAPPED' AND discount_amount > 0 THEN gross_amount
                 WHEN _dq_flag = 'MANUAL_ERROR'
                 THEN net_amount + ((CAST(substr(pos_txn_id, 5) AS BIGINT) // 25) % 17 - 8) * 20.00
                 ELSE net_amount END AS DECIMAL(18,2)) AS sap_net_,
       CAST(CASE WHEN _dq_flag = 'PROMO_UNMAPPED' AND discount_amount > 0
                 THEN round(abs(gross_amount) * 0.01 * (CAST(substr(tax_code, 3) AS INTEGER) + 5), 2)
                 ELSE tax_amount_local END AS DECIMAL(18,2)) AS sap_tax_,
       _dq_flag = 'MANUAL_ERROR' AS _manual_error
FROM raw_pos_transaction_header h
WHERE txn_status = 'COMPLETED' AND sap_doc_number IS NOT NULL AND sap_doc_number <> ''
  AND _dq_flag IS NOT NULL AND _dq_flag NOT IN ('SAP_BATCH_FAIL', 'NULL_STORE', 'WRONG_COUNTRY', 'FUTURE_DATE')"""

CTES["raw_sap_fi_document"] = """
SELECT sap_doc_number AS belnr, sap_company_code AS bukrs, CAST(year(business_date) AS INTEGER) AS gjahr, country_code,
       CASE WHEN txn_type = 'RETURN' THEN 'RE' ELSE 'RV' END AS blart,
       business_date AS bldat, budat_ AS budat, currency_code AS waers, receipt_number AS xblnr,
       CASE WHEN _manual_error THEN 'MANUAL_USER' ELSE 'BATCH_POS' END AS usnam,
       CASE WHEN CAST(substr(pos_txn_id, 5) AS BIGINT) % 7 = 0 THEN ' ' END AS bstat,
       CAST(NULL AS VARCHAR) AS stblg, country_code AS tax_country, pos_txn_id, _dq_flag, _manual_error
FROM postable"""

CTES["raw_sap_fi_lineitem"] = """
SELECT p.sap_doc_number AS belnr, p.sap_company_code AS bukrs, CAST(year(p.business_date) AS INTEGER) AS gjahr,
       l.buzei, l.hkont,
       CASE WHEN l.buzei = '001' THEN (CASE WHEN p.sap_net_ >= 0 THEN 'S' ELSE 'H' END)
            ELSE (CASE WHEN p.sap_net_ >= 0 THEN 'H' ELSE 'S' END) END AS shkzg,
       CAST(CASE l.buzei WHEN '001' THEN abs(p.sap_net_) + abs(p.sap_tax_)
                         WHEN '002' THEN abs(p.sap_net_) ELSE abs(p.sap_tax_) END AS DECIMAL(18,2)) AS dmbtr,
       p.currency_code AS hwae, CAST(NULL AS VARCHAR) AS augbl, CAST(NULL AS DATE) AS augdt,
       CASE WHEN l.buzei <> '001' THEN p.tax_code END AS mwskz,
       CAST(NULL AS VARCHAR) AS kostl, CAST(NULL AS VARCHAR) AS prctr, l.sgtxt, p._dq_flag
FROM postable p
CROSS JOIN (VALUES ('001', '0011900000', 'POS clearing'), ('002', '0040000001', 'Sales revenue'),
                   ('003', '0021000000', 'Tax payable')) AS l(buzei, hkont, sgtxt)
WHERE l.buzei <> '003' OR abs(p.sap_tax_) > 0"""

CTES["stl_base"] = """
SELECT t.settlement_batch, t.country_code, t.business_date, t.tender_code, t.currency_code, c.sap_company_code,
       CAST(sum(t.tender_amount) AS DECIMAL(18,2)) AS gross_amount, count(*) AS txn_count,
       min(CAST(substr(t.pos_txn_id, 5) AS BIGINT)) AS kk
FROM raw_pos_tender t JOIN raw_dim_country c ON t.country_code = c.country_code AND c.is_active
WHERE t.tender_amount > 0 AND t.tender_code IS NOT NULL AND t.tender_code NOT IN ('CASH', 'VOUCHER')
GROUP BY t.settlement_batch, t.country_code, t.business_date, t.tender_code, t.currency_code, c.sap_company_code"""

CTES["stl_rated"] = """
SELECT b.*, tt.interchange_rate_pct AS contracted, tt.settlement_lag_days AS lag,
       CASE WHEN kk % 200 = 4 THEN 'MISSING_CREDIT' WHEN kk % 100 = 2 THEN 'FEE_DISPUTE'
            WHEN kk % 100 = 8 THEN 'FEE_VARIANCE' WHEN kk % 60 = 5 THEN 'ROUNDING_DIFF'
            WHEN kk % 150 = 6 THEN 'SHORT_CREDIT' ELSE 'CLEAN' END AS flag,
       CAST(CASE WHEN kk % 200 <> 4 AND kk % 100 IN (2, 8) THEN tt.interchange_rate_pct * 1.1
                 ELSE tt.interchange_rate_pct END AS DECIMAL(8,4)) AS actual
FROM stl_base b LEFT JOIN raw_dim_tender_type tt ON b.tender_code = tt.tender_code"""

CTES["raw_bank_card_settlement"] = """
SELECT 'STL-' || substr(settlement_batch, 7) AS settlement_id, country_code,
       CASE tender_code WHEN 'NETS' THEN 'NETS_OPERATOR' WHEN 'PAYNOW' THEN 'FAST_NETWORK'
                        WHEN 'AMEX' THEN 'AMEX_DIRECT' ELSE 'MERCHANT_SERVICES_' || country_code END AS processor_name,
       'MER-' || regexp_extract(settlement_batch, '^BATCH-(ST-[0-9]+|NOSTORE)-', 1) AS merchant_id,
       'Merchant ' || regexp_extract(settlement_batch, '^BATCH-(ST-[0-9]+|NOSTORE)-', 1) AS merchant_name,
       business_date AS txn_date, CAST(business_date + CAST(coalesce(lag, 1) AS INTEGER) AS DATE) AS settle_date,
       currency_code, tender_code, CAST(txn_count AS BIGINT) AS txn_count, gross_amount,
       CAST(0 AS DECIMAL(18,2)) AS refund_amount, CAST(0 AS DECIMAL(18,2)) AS chargeback_amount,
       CAST(round(gross_amount * actual * 0.01, 2) AS DECIMAL(18,2)) AS interchange_fee,
       CAST(contracted AS DECIMAL(8,4)) AS contracted_rate_pct, actual AS actual_rate_pct,
       CAST(gross_amount - CAST(round(gross_amount * actual * 0.01, 2) AS DECIMAL(18,2)) AS DECIMAL(18,2))
            AS net_settlement,
       settlement_batch AS settlement_batch_id,
       'ACCT-' || lpad(CAST(CAST(substr(sap_company_code, 2) AS INTEGER) AS VARCHAR), 3, '0') AS bank_account,
       'BANK' || CAST(CAST(substr(sap_company_code, 2) AS INTEGER) AS VARCHAR) AS bank_code,
       'OPEN' AS sap_clear_status, CAST(NULL AS VARCHAR) AS sap_clear_doc, flag AS _dq_flag
FROM stl_rated"""

CTES["raw_bank_statement_line"] = """
SELECT 'BSL-' || s.country_code || '-'
         || lpad(CAST(row_number() OVER (PARTITION BY s.country_code ORDER BY s.settle_date, s.settlement_id)
                      AS VARCHAR), 8, '0') AS statement_line_id,
       s.country_code, s.bank_code, s.bank_account, s.currency_code, s.settle_date AS value_date,
       CAST(CASE s._dq_flag
              WHEN 'FEE_DISPUTE' THEN s.gross_amount - round(s.gross_amount * s.contracted_rate_pct * 0.01, 2)
              WHEN 'ROUNDING_DIFF' THEN s.net_settlement - 0.50
              WHEN 'SHORT_CREDIT' THEN s.net_settlement - 25
              ELSE s.net_settlement END AS DECIMAL(18,2)) AS amount,
       'C' AS dc_indicator, c.bank_transfer_rail AS payment_rail, s.settlement_batch_id AS customer_reference,
       CASE WHEN s.tender_code = 'PAYNOW' THEN 'FAST' || s.settlement_id END AS fast_ref,
       s.processor_name || ' SETTLEMENT ' || s.settlement_batch_id AS narrative,
       'OPEN' AS sap_clear_status, CAST(NULL AS VARCHAR) AS sap_clear_doc, s._dq_flag,
       s.settlement_id AS _settle_id
FROM raw_bank_card_settlement s LEFT JOIN raw_dim_country c ON s.country_code = c.country_code
WHERE s._dq_flag <> 'MISSING_CREDIT'"""

CTES["rmr_cfg"] = """
SELECT country_code, country_code_iso2 AS iso, sap_company_code AS company, regulatory_body,
       1000 * (CAST(substr(sap_company_code, 2) AS INTEGER) + 1) AS ticket_base,
       variance_threshold_t2 AS t2, variance_threshold_t3 AS t3
FROM raw_dim_country WHERE is_active"""

# Every match in one shape: which side it is, what was expected and found, and
# the tier as the number of bounds that the distance exceeds.
CTES["rmr_found"] = """
SELECT 0 AS kind, e.country_code, e.business_date AS day, e.store_id AS ord, e.store_id, e.currency_code, e.fiscal_period_key,
       right(e.store_id, 3) AS tail, e.net_sales AS expected, e._dq_flag, e.net_sales AS drawn,
       (SELECT sum(CASE l.shkzg WHEN 'H' THEN l.dmbtr ELSE -l.dmbtr END)
        FROM raw_sap_fi_document d JOIN raw_sap_fi_lineitem l USING (belnr, bukrs, gjahr)
        WHERE starts_with(l.hkont, '004') AND d.bldat = e.business_date AND d.bukrs = c.company) AS found
FROM raw_pos_eod_summary e JOIN rmr_cfg c USING (country_code)
UNION ALL
SELECT 1, s.country_code, s.settle_date, s.settlement_id,
       nullif(regexp_extract(s.settlement_batch_id, '^BATCH-(ST-[0-9]+)-', 1), ''), s.currency_code,
       s.country_code || '-' || strftime(s.settle_date, '%Y-%m'), right(s.settlement_batch_id, 6), s.net_settlement, s._dq_flag,
       s.gross_amount,
       (SELECT max_by(b.amount, (b.value_date, b.statement_line_id)) FROM raw_bank_statement_line b
        WHERE b.customer_reference = s.settlement_batch_id)
FROM raw_bank_card_settlement s JOIN rmr_cfg c USING (country_code)"""

CTES["rmr_distance"] = """
SELECT *, CAST(coalesce(found, 0) AS DECIMAL(18,2)) AS actual, CAST(expected - coalesce(found, 0) AS DECIMAL(18,2)) AS gap,
       CAST(drawn * 100 AS BIGINT) AS cents,
       (abs(expected - coalesce(found, 0)) > 0.01)::INTEGER + (abs(expected - coalesce(found, 0)) > t2)::INTEGER
         + (kind = 0 AND abs(expected - coalesce(found, 0)) > t3)::INTEGER AS tier
FROM rmr_found JOIN rmr_cfg USING (country_code)"""

# flag of a row -> what it settles by itself (level 0), or the cause of an unmatched sales day (level 3)
CTES["rmr_flags"] = """
SELECT * FROM (VALUES (0, 'SAP_BATCH_FAIL', 0, 'UNMATCHED', 'RC-001'), (1, 'MISSING_CREDIT', 0, 'UNMATCHED', 'RC-014'),
  (1, 'CHARGEBACK', 0, 'UNMATCHED', 'RC-011'), (1, 'FEE_DISPUTE', 0, 'TOLERANCE', 'RC-010'), (1, 'FEE_VARIANCE', 0, 'TOLERANCE', 'RC-010'),
  (0, 'ROUNDING_DIFF', 3, 'UNMATCHED', 'RC-007'), (0, 'WRONG_PERIOD', 3, 'UNMATCHED', 'RC-008'),
  (0, 'DUPLICATE_TXN', 3, 'UNMATCHED', 'RC-005')) AS f(kind, _dq_flag, level, f_type, f_cause)"""

CTES["rmr_judged"] = """
SELECT d.* EXCLUDE (tier), CASE WHEN f.level = 0 THEN 9 ELSE tier END AS tier,
       CASE WHEN f.level = 0 THEN f_type ELSE ['EXACT', 'TOLERANCE', CASE kind WHEN 0 THEN 'TOLERANCE' ELSE 'UNMATCHED' END, 'UNMATCHED'][tier + 1] END AS m_type,
       CASE WHEN f.level IS DISTINCT FROM 0 AND tier < 2 THEN 'MATCHED' ELSE 'EXCEPTION' END AS m_status,
       CASE WHEN f.level = 0 OR f.level = tier THEN f_cause
            WHEN kind = 1 THEN [NULL, NULL, 'RC-009'][tier + 1]
            ELSE [NULL, CASE WHEN abs(gap) < 1 THEN 'RC-007' END,
                  CASE WHEN contains(_dq_flag, 'PROMO') THEN 'RC-003' ELSE 'RC-007' END, 'RC-003'][tier + 1] END AS cause
FROM rmr_distance d LEFT JOIN rmr_flags f USING (kind, _dq_flag)"""

CTES["rmr_named"] = """
SELECT *, CASE kind WHEN 0 THEN 'MATCH-POS-SAP-' ELSE 'MATCH-PAY-BANK-' END || iso || '-' || strftime(day, '%Y%m%d') || '-' || tail AS match_id,
       m_status = 'EXCEPTION' AND (kind = 1 OR abs(gap) >= t3) AS ticketed,
       m_status = 'EXCEPTION' AND day < DATE '2001-07-01' AND abs(cents) % 100 < [85, 80][kind + 1] AS cleared
FROM rmr_judged"""

CTES["raw_recon_match_result"] = """
SELECT match_id, ['POS_SAP', 'PAY_BANK'][kind + 1] AS recon_type, country_code, day AS recon_date, fiscal_period_key, store_id,
       currency_code, CAST(CASE kind WHEN 0 THEN expected ELSE 0 END AS DECIMAL(18,2)) AS pos_amount,
       CAST(CASE kind WHEN 0 THEN actual ELSE expected END AS DECIMAL(18,2)) AS sap_amount,
       CAST(CASE kind WHEN 0 THEN 0 ELSE actual END AS DECIMAL(18,2)) AS bank_amount,
       CAST(CASE kind WHEN 0 THEN gap ELSE 0 END AS DECIMAL(18,2)) AS variance_pos_sap,
       CAST(CASE kind WHEN 0 THEN 0 ELSE gap END AS DECIMAL(18,2)) AS variance_sap_bank, t3 AS threshold_applied,
       CASE WHEN cleared THEN 'MANUAL' ELSE m_type END AS match_type,
       CASE WHEN cleared THEN 'MATCHED' ELSE m_status END AS match_status, cause AS root_cause_code,
       CASE WHEN m_status = 'EXCEPTION' AND NOT cleared THEN regulatory_body END AS regulatory_ref,
       CASE WHEN ticketed THEN 'INC-' || iso || '-' || year(day) || '-'
            || (ticket_base + row_number() OVER (PARTITION BY country_code, ticketed ORDER BY kind, day, ord, match_id)) END AS it_ticket_ref,
       'EMP-' || iso || '-2014' || (abs(cents) % 100 % 3 + 5) AS preparer_id,
       CASE WHEN cleared OR m_status = 'MATCHED' THEN 'EMP-' || iso || '-1002' || (abs(cents) % 100 % 2 + 3) END AS reviewer_id,
       CASE WHEN cleared OR m_status = 'MATCHED' THEN CAST(day AS TIMESTAMP) + INTERVAL 570 MINUTE END AS reviewed_at, _dq_flag
FROM rmr_named"""

CTES["raw_dim_bank"] = """
SELECT 'BANK' || CAST(CAST(substr(sap_company_code, 2) AS INTEGER) AS VARCHAR) AS bank_code, country_code,
       'Bank of ' || country_name AS bank_name,
       'B' || CAST(CAST(substr(sap_company_code, 2) AS INTEGER) AS VARCHAR) AS bank_short_name,
       'BNK' || CAST(CAST(substr(sap_company_code, 2) AS INTEGER) AS VARCHAR) || 'XXX' AS swift_bic,
       'ACCT-' || lpad(CAST(CAST(substr(sap_company_code, 2) AS INTEGER) AS VARCHAR), 3, '0') AS bank_account_no,
       'CURRENT' AS account_type,
       'HB' || CAST(CAST(substr(sap_company_code, 2) AS INTEGER) AS VARCHAR) AS sap_house_bank,
       'AC' || CAST(CAST(substr(sap_company_code, 2) AS INTEGER) AS VARCHAR) AS sap_account_id,
       'MT940' AS statement_format, bank_transfer_rail AS transfer_rail, '16:00' AS settlement_cut_off,
       CAST(NULL AS VARCHAR) AS contact_name, is_active
FROM raw_dim_country"""

CTES["raw_dim_tax_code"] = """
SELECT country_code || '-TX' || CAST(CAST(substr(sap_company_code, 2) AS INTEGER) AS VARCHAR) AS tax_code_key,
       country_code, 'TX' || CAST(CAST(substr(sap_company_code, 2) AS INTEGER) AS VARCHAR) AS tax_code,
       tax_system AS tax_type, tax_system || ' standard rate' AS tax_description,
       CAST(tax_rate_standard AS DECIMAL(8,4)) AS tax_rate_pct, DATE '1990-01-01' AS effective_date,
       CAST(NULL AS DATE) AS end_date, 'S' || CAST(CAST(substr(sap_company_code, 2) AS INTEGER) AS VARCHAR) AS sap_tax_code,
       FALSE AS is_exempt, '0021000000' AS gl_account_tax, 'MONTHLY' AS filing_frequency,
       'AUTH-' || CAST(CAST(substr(sap_company_code, 2) AS INTEGER) AS VARCHAR) AS tax_authority
FROM raw_dim_country"""

CTES["spine_country"] = """
SELECT country_code, CAST(unnest(generate_series(min(business_date), max(business_date), INTERVAL 1 DAY)) AS DATE)
       AS date_key
FROM raw_pos_transaction_header GROUP BY country_code"""

CTES["raw_dim_fiscal_calendar"] = """
SELECT s.country_code || '-' || strftime(s.date_key, '%Y-%m') AS fiscal_period_key, s.country_code, s.date_key,
       CAST(year(s.date_key) AS INTEGER) AS fiscal_year, CAST(month(s.date_key) AS INTEGER) AS fiscal_period,
       'Q' || CAST(quarter(s.date_key) AS VARCHAR) AS fiscal_quarter,
       CAST(date_trunc('month', s.date_key) AS DATE) AS period_start_date, last_day(s.date_key) AS period_end_date,
       CAST(date_trunc('month', s.date_key) AS DATE) >= DATE '{as_of_month}' AS is_period_open,
       month(s.date_key) = 12 AS is_year_end_period,
       isodow(s.date_key) - 1 < 5 AND h.name IS NULL AS working_day_flag,
       h.name AS public_holiday_name
FROM spine_country s
JOIN raw_dim_country c ON s.country_code = c.country_code AND c.is_active
LEFT JOIN (VALUES (1, 1, 'New Year''s Day'), (5, 1, 'Labour Day'), (12, 25, 'Christmas Day')) AS h(m, d, name)
       ON month(s.date_key) = h.m AND day(s.date_key) = h.d"""

CTES["spine_currency"] = """
SELECT currency_code, CAST(unnest(generate_series(min(business_date), max(business_date), INTERVAL 1 DAY)) AS DATE)
       AS date_key
FROM raw_pos_transaction_header GROUP BY currency_code"""

CTES["raw_dim_currency"] = """
SELECT s.currency_code, c.country_name || ' currency' AS currency_name, s.currency_code AS currency_symbol,
       2 AS decimal_places, s.date_key AS rate_date,
       CAST(round((0.20 + CAST(substr(c.sap_company_code, 2) AS INTEGER) * 0.05)
            * (1 + CAST((date_diff('day', DATE '1990-01-01', s.date_key) * 37
                         + CAST(substr(c.sap_company_code, 2) AS INTEGER) * 11) % 601 - 300 AS DECIMAL(10,0))
                   * 0.00001), 6) AS DECIMAL(18,6)) AS rate_to_usd,
       CAST(round(CAST(round((0.20 + CAST(substr(c.sap_company_code, 2) AS INTEGER) * 0.05)
            * (1 + CAST((date_diff('day', DATE '1990-01-01', s.date_key) * 37
                         + CAST(substr(c.sap_company_code, 2) AS INTEGER) * 11) % 601 - 300 AS DECIMAL(10,0))
                   * 0.00001), 6) AS DECIMAL(18,6)) * 1.35, 6) AS DECIMAL(18,6)) AS rate_to_sgd,
       'FIXED-DRIFT' AS rate_source, FALSE AS is_group_currency
FROM spine_currency s JOIN raw_dim_country c ON s.currency_code = c.base_currency"""

CTES["raw_sap_fi_lineitem_from_lineitem"] = """
SELECT CAST(l.l_orderkey AS VARCHAR) AS belnr, 'C' || lpad(CAST(g2.r_regionkey AS VARCHAR), 3, '0') AS bukrs,
       CAST(year(o.o_orderdate) AS INTEGER) AS gjahr,
       CASE WHEN length(CAST(l.l_linenumber AS VARCHAR)) >= 3 THEN CAST(l.l_linenumber AS VARCHAR)
            ELSE lpad(CAST(l.l_linenumber AS VARCHAR), 3, '0') END AS buzei,
       CASE l.l_returnflag WHEN 'A' THEN '0040000001' WHEN 'R' THEN '0040000009' WHEN 'N' THEN '0011900000'
            ELSE '0011900000' END AS hkont,
       CASE l.l_linestatus WHEN 'O' THEN 'H' WHEN 'F' THEN 'S' ELSE 'S' END AS shkzg,
       CAST(l.l_extendedprice AS DECIMAL(18,2)) AS dmbtr, substr(g2.r_name, 1, 3) AS hwae,
       CAST(NULL AS VARCHAR) AS augbl, CAST(NULL AS DATE) AS augdt, CAST(NULL AS VARCHAR) AS mwskz,
       CAST(NULL AS VARCHAR) AS kostl, CAST(NULL AS VARCHAR) AS prctr, 'LINE ' || CAST(l.l_linenumber AS VARCHAR) AS sgtxt,
       'CLEAN' AS _dq_flag
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
JOIN geo g2 ON c.c_nationkey = g2.n_nationkey"""
