"""The test tables presented as the raw tables of the models.

One SELECT per raw table in SQL common to Spark and DuckDB, so both sides of a comparison start from
the same text. Every table is read whole; rows are split between raw tables by their own attributes
(late usage by hour of day). Dates are
moved by 23 years into the default reporting window. ``_row_seq`` is the load order of repeated rows.
"""

BINDINGS = {
    "raw_customers": """
        SELECT 'CUST-' || lpad(cast(c_custkey AS varchar(20)), 9, '0') AS customer_id,
        ' ' || c_name || ' ' AS company_name,
        lower(c_mktsegment) AS industry,
        CASE WHEN c_custkey % 2 = 0 THEN '' ELSE lower(r_name) END AS region,
        n_name AS country,
        CASE WHEN c_custkey % 7 = 0 THEN ' ' ELSE 'city' || cast(c_nationkey AS varchar(20)) END AS city,
        cast(cast(DATE '2018-01-01' + cast(c_custkey % 1500 AS int) AS date) AS varchar(20)) AS signup_date,
        'owner' || cast(c_nationkey AS varchar(20)) AS account_owner,
        CASE WHEN c_acctbal < -500 THEN 'Churned' WHEN c_acctbal < 0 THEN 'suspended ' WHEN c_acctbal < 1000 THEN
          'inactive' WHEN c_acctbal < 2000 THEN 'trial' ELSE 'ACTIVE' END AS status,
        upper(c_name) || '@example.com' AS email,
        '' AS phone,
        CASE WHEN c_custkey % 11 = 0 THEN 'n/a' ELSE cast(c_custkey % 500 AS varchar(20)) END AS employee_count,
        cast(c_custkey * 1000 AS varchar(20)) AS annual_revenue_usd,
        CASE c_custkey % 5 WHEN 0 THEN '-' WHEN 1 THEN 'N/A' WHEN 2 THEN '' ELSE 'note' END AS notes,
        CASE WHEN c_mktsegment = 'MACHINERY' THEN 'enterprise' WHEN c_mktsegment = 'BUILDING' THEN 'mid_market' ELSE
          'smb' END AS account_tier
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    """,
    "country_region": """
        SELECT n_name AS country,
        r_name AS region
        FROM nation JOIN region ON n_regionkey = r_regionkey
    """,
    "raw_plans": """
        SELECT 'PLN-' || p_type AS plan_id,
        lower(p_type) AS plan_name,
        cast(cast(min(p_retailprice) AS decimal(10,2)) AS varchar(20)) AS base_price,
        CASE WHEN p_type IN ('SMALL', 'ECONOMY') THEN 'flat' ELSE 'usage_plus_base' END AS billing_model,
        cast(count(*) AS varchar(20)) AS api_limit,
        cast(max(p_size) AS varchar(20)) AS storage_gb,
        CASE p_type WHEN 'ECONOMY' THEN NULL WHEN 'SMALL' THEN 'dashboard' WHEN 'MEDIUM' THEN 'dashboard,reporting'
          ELSE 'dashboard,reporting,webhooks' END AS features,
        '2024-02-01' AS effective_date,
        CASE WHEN p_type = 'SMALL' THEN 'False' ELSE 'True' END AS is_active
        FROM part GROUP BY p_type
    """,
    "raw_subscriptions": """
        SELECT 'SUB-' || lpad(cast(o_orderkey AS varchar(20)), 9, '0') AS subscription_id,
        'CUST-' || lpad(cast(o_custkey AS varchar(20)), 9, '0') AS customer_id,
        'PLN-' || CASE o_orderkey % 6 WHEN 0 THEN 'ECONOMY' WHEN 1 THEN 'SMALL' WHEN 2 THEN 'MEDIUM' WHEN 3 THEN
          'LEGACY' WHEN 4 THEN 'STANDARD' ELSE 'LARGE' END AS plan_id,
        cast(cast(o_orderdate + INTERVAL 23 YEAR AS date) AS varchar(20)) AS start_date,
        CASE WHEN o_orderkey % 3 = 0 THEN cast(cast(cast(o_orderdate + INTERVAL 23 YEAR AS date) + cast(o_orderkey %
          400 - 5 AS int) AS date) AS varchar(20)) END AS end_date,
        cast(cast(o_totalprice AS decimal(10,2)) AS varchar(20)) AS mrr,
        CASE o_orderpriority WHEN '1-URGENT' THEN 'monthly' WHEN '2-HIGH' THEN 'quarterly' WHEN '3-MEDIUM' THEN
          'annual' WHEN '4-NOT SPECIFIED' THEN 'monthly' ELSE 'annual' END AS billing_cycle,
        CASE WHEN o_orderkey % 4 = 0 THEN 'False' ELSE 'True' END AS auto_renew,
        CASE WHEN o_orderstatus = 'O' THEN 'Active' WHEN o_orderstatus = 'P' THEN 'suspended' WHEN o_orderkey % 2 = 0
          THEN 'cancelled' ELSE 'expired' END AS status
        FROM orders
    """,
    "raw_invoices": """
        SELECT 'INV-' || cast(l_orderkey AS varchar(20)) || '-' || cast(l_linenumber AS varchar(20)) AS invoice_id,
        cast(o_custkey AS varchar(20)) AS customer_id,
        'SUB-' || lpad(cast(l_orderkey AS varchar(20)), 9, '0') AS subscription_id,
        cast(cast(l_shipdate + INTERVAL 23 YEAR AS date) AS varchar(20)) AS invoice_date,
        cast(cast(cast(l_shipdate + INTERVAL 23 YEAR AS date) + CASE WHEN l_partkey % 50 = 0 THEN -5 ELSE 30 END AS
          date) AS varchar(20)) AS due_date,
        cast(cast(l_extendedprice AS decimal(12,2)) AS varchar(20)) AS amount,
        'USD' AS currency,
        CASE WHEN l_returnflag = 'A' THEN 'Paid' WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'overdue' WHEN
          l_returnflag = 'N' THEN 'pending' WHEN l_linenumber % 2 = 0 THEN 'disputed' ELSE 'void' END AS status,
        cast(l_linenumber AS varchar(20)) AS line_items_count,
        cast(cast(l_extendedprice AS decimal(12,2)) * cast(l_tax AS decimal(4,2)) AS varchar(20)) AS tax_amount,
        cast(cast(l_extendedprice AS decimal(12,2)) * cast(1 + l_tax AS decimal(4,2)) AS varchar(20)) AS total_amount,
        cast(cast(l_shipdate + INTERVAL 23 YEAR AS date) AS varchar(20)) AS period_start,
        cast(cast(cast(l_shipdate + INTERVAL 23 YEAR AS date) + 30 AS date) AS varchar(20)) AS period_end,
        cast(cast(l_shipdate + INTERVAL 23 YEAR AS date) AS varchar(20)) AS created_at,
        cast(l_suppkey % 3 + 1 AS varchar(20)) AS _batch_id,
        l_partkey * 1000 + l_suppkey AS _row_seq
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    """,
    "raw_payments": """
        SELECT 'PAY-' || cast(l_orderkey AS varchar(20)) || '-' || cast(l_linenumber AS varchar(20)) AS payment_id,
        CASE WHEN l_partkey % 40 = 0 THEN '' ELSE 'INV-' || cast(l_orderkey AS varchar(20)) || '-' ||
          cast(l_linenumber AS varchar(20)) END AS invoice_id,
        CASE WHEN o_custkey % 2 = 0 THEN 'C' || cast(o_custkey AS varchar(20)) ELSE cast(o_custkey AS varchar(20)) END
          AS customer_id,
        cast(cast(l_extendedprice AS decimal(12,2)) AS varchar(20)) AS amount,
        CASE WHEN l_suppkey % 2 = 0 THEN 'Card' ELSE 'wire ' END AS payment_method,
        cast(cast(l_shipdate + INTERVAL 23 YEAR AS date) AS varchar(20)) || 'T23:30:00-05:00' AS payment_date,
        CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN 'refunded' WHEN l_returnflag = 'R' THEN 'failed' ELSE
          'Completed' END AS status,
        CASE WHEN l_suppkey % 9 = 0 THEN '' ELSE 'TXN' || cast(l_partkey AS varchar(20)) END AS transaction_ref,
        cast(cast(l_extendedprice AS decimal(12,2)) * cast(0.03 AS decimal(4,2)) AS varchar(20)) AS processor_fee,
        cast(cast(l_extendedprice AS decimal(12,2)) * cast(0.97 AS decimal(4,2)) AS varchar(20)) AS net_amount,
        cast(l_suppkey % 3 + 1 AS varchar(20)) AS _batch_id,
        l_partkey * 1000 + l_suppkey AS _row_seq
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    """,
    "raw_usage_events": """
        SELECT 'CUST-' || lpad(cast(user_id AS varchar(20)), 9, '0') AS customer_id,
        cast(cast(cast(ts AS date) + CASE event_id % 3 WHEN 0 THEN INTERVAL 0 MONTH WHEN 1 THEN INTERVAL 1 MONTH ELSE
          INTERVAL 2 MONTH END AS date) AS varchar(20)) AS event_date,
        CASE event_type WHEN 'click' THEN 'API_requests' WHEN 'view' THEN 'active_users' WHEN 'signup' THEN
          'workflow_executions' ELSE 'storage_used_gb' END AS metric_name,
        cast(cast(value AS decimal(14,4)) AS varchar(20)) AS quantity,
        'unit' AS unit,
        cast(event_id % 5 % 3 + 1 AS varchar(20)) AS _batch_id,
        event_id AS _row_seq
        FROM events WHERE event_type <> 'error' AND hour(ts) < 22
    """,
    "raw_late_usage": """
        SELECT 'CUST-' || lpad(cast(user_id AS varchar(20)), 9, '0') AS customer_id,
        cast(cast(ts AS date) AS varchar(20)) AS event_date,
        'api_requests' AS metric_name,
        cast(cast(value AS decimal(14,4)) AS varchar(20)) AS quantity,
        'unit' AS unit,
        '3' AS _batch_id,
        event_id AS _row_seq
        FROM events WHERE event_type <> 'error' AND hour(ts) >= 22
    """,
    "raw_product_events": """
        SELECT 'EVT-' || cast(event_id AS varchar(20)) AS event_id,
        'CUST-' || lpad(cast(user_id AS varchar(20)), 9, '0') AS customer_id,
        CASE event_id % 4 WHEN 0 THEN 'apiGateway' WHEN 1 THEN 'api_gateway' WHEN 2 THEN 'workflow-builder' ELSE '
          Webhooks' END AS feature,
        event_type AS action,
        cast(cast(ts AS date) AS varchar(20)) || 'T12:00:00Z' AS timestamp,
        CASE WHEN event_id % 6 = 0 THEN '' ELSE 's' || cast(user_id AS varchar(20)) END AS session_id,
        props AS user_agent,
        cast(event_id % 3 + 1 AS varchar(20)) AS _batch_id
        FROM events
    """,
    "raw_support_tickets": """
        SELECT 'TKT-' || cast(event_id AS varchar(20)) AS ticket_id,
        'CUST-' || lpad(cast(user_id AS varchar(20)), 9, '0') AS customer_id,
        CASE event_id % 5 WHEN 0 THEN 'Billing' WHEN 1 THEN 'technical' WHEN 2 THEN 'account' ELSE 'general' END AS
          category,
        CASE event_id % 4 WHEN 0 THEN 'critical' WHEN 1 THEN 'High' WHEN 2 THEN 'medium' ELSE 'low' END AS priority,
        cast(cast(cast(ts AS date) + cast((b - 1) * 3 AS int) AS date) AS varchar(20)) || 'T08:00:00Z' AS created_at,
        CASE WHEN b = 3 AND event_id % 3 <> 0 THEN cast(cast(cast(ts AS date) + cast(event_id % 11 AS int) AS date) AS
          varchar(20)) || 'T20:00:00Z' ELSE '' END AS resolved_at,
        CASE WHEN b = 3 AND event_id % 3 <> 0 THEN cast(event_id % 11 * 24 AS varchar(20)) ELSE '' END AS
          resolution_hours,
        CASE WHEN event_id % 7 = 0 THEN '' ELSE cast(1 + event_id % 5 AS varchar(20)) END AS satisfaction_score,
        'agent' AS agent_name,
        'Email' AS channel,
        props AS description,
        cast(b AS varchar(20)) AS _batch_id
        FROM events CROSS JOIN (SELECT 1 AS b UNION ALL SELECT 2 UNION ALL SELECT 3) bs WHERE event_type = 'error' AND
          b >= CASE WHEN day(ts) <= 15 THEN 1 ELSE 2 END
    """,
    "raw_adjustments": """
        SELECT 'ADJ-' || cast(l_orderkey AS varchar(20)) || '-' || cast(l_linenumber AS varchar(20)) || '-' ||
          cast(l_partkey AS varchar(20)) || '-' || cast(l_suppkey AS varchar(20)) AS adjustment_id,
        CASE WHEN l_partkey % 3 = 0 THEN 'CUST-' || lpad(cast(o_custkey AS varchar(20)), 9, '0') ELSE cast(o_custkey
          AS varchar(20)) END AS customer_id,
        'INV-' || cast(l_orderkey AS varchar(20)) || '-' || cast(l_linenumber AS varchar(20)) AS invoice_id,
        CASE l_partkey % 5 WHEN 0 THEN 'Credit' WHEN 1 THEN 'refund' WHEN 2 THEN 'write_off' WHEN 3 THEN 'correction'
          ELSE 'reversal' END AS adjustment_type,
        cast(cast(l_extendedprice * 1 AS decimal(12,2)) AS varchar(20)) AS amount,
        'reason' AS reason,
        lpad(cast(l_partkey % 3 + 1 AS varchar(20)), 2, '0') || '/' || lpad(cast(l_orderkey % 28 + 1 AS varchar(20)),
          2, '0') || '/2024' AS effective_date,
        lpad(cast(l_partkey % 3 + 1 AS varchar(20)), 2, '0') || '/' || lpad(cast(l_orderkey % 28 + 2 AS varchar(20)),
          2, '0') || '/2024' AS created_at,
        CASE WHEN l_suppkey % 4 = 0 THEN '' ELSE 'approver' END AS approved_by,
        CASE l_suppkey % 3 WHEN 0 THEN 'Approved' WHEN 1 THEN 'pending' ELSE 'rejected' END AS status,
        CASE WHEN l_partkey % 5 = 4 THEN 'ADJ-1' ELSE '' END AS reverses_adjustment_id,
        cast(l_suppkey % 2 + 2 AS varchar(20)) AS _batch_id
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    """,
    "raw_contract_amendments": """
        SELECT 'AMD-' || cast(o_orderkey AS varchar(20)) AS amendment_id,
        'CUST-' || lpad(cast(o_custkey AS varchar(20)), 9, '0') AS customer_id,
        'SUB-' || lpad(cast(o_orderkey AS varchar(20)), 9, '0') AS subscription_id,
        CASE o_orderkey % 7 WHEN 0 THEN 'Upgrade' WHEN 1 THEN 'downgrade' WHEN 2 THEN 'renewal' WHEN 3 THEN
          'cancellation' WHEN 4 THEN 'add_on' ELSE 'price_override' END AS amendment_type,
        'PLN-SMALL' AS old_plan_id,
        CASE WHEN o_orderkey % 2 = 0 THEN 'PLN-PROMO' ELSE 'PLN-LARGE' END AS new_plan_id,
        cast(cast(o_totalprice AS decimal(10,2)) AS varchar(20)) AS old_mrr,
        CASE WHEN o_orderkey % 9 = 0 THEN cast(cast(o_totalprice AS decimal(10,2)) AS varchar(20)) WHEN o_orderkey % 4
          = 1 THEN '100.00' ELSE cast(cast(o_totalprice AS decimal(10,2)) + 250.50 AS varchar(20)) END AS new_mrr,
        cast(cast(DATE '2023-12-01' + cast(o_orderkey % 130 AS int) AS date) AS varchar(20)) AS effective_date,
        cast(cast(DATE '2024-02-01' + cast(o_orderkey % 50 AS int) AS date) AS varchar(20)) || 'T00:00:00Z' AS
          created_at,
        'reason' AS reason,
        'approver' AS approved_by,
        cast(o_orderkey % 2 + 2 AS varchar(20)) AS _batch_id
        FROM orders
    """,
    "raw_partner_referrals": """
        SELECT 'REF-' || cast(s_suppkey AS varchar(20)) AS referral_id,
        CASE s_suppkey % 4 WHEN 0 THEN ' customer#' || lpad(cast(s_suppkey * 3 AS varchar(20)), 9, '0') || '@Example.com'
          WHEN 1 THEN '' ELSE 'partner' || cast(s_suppkey AS varchar(20)) || '@example.com' END AS email,
        CASE s_suppkey % 4 WHEN 1 THEN 'CUSTOMER - ' || lpad(cast(s_suppkey * 7 AS varchar(20)), 9, '0') WHEN 2 THEN
          'Customer #' || lpad(cast(s_suppkey * 5 AS varchar(20)), 9, '0') || ' SE' ELSE s_name END AS company_name
        FROM supplier
    """,
    "raw_corrections": """
        SELECT 'COR-' || lpad(cast(l_orderkey AS varchar(20)), 9, '0') || '-' || cast(l_linenumber AS varchar(20)) AS correction_id,
        CASE WHEN l_orderkey % 13 = 0 THEN 'unknown' ELSE 'invoice' END AS entity_type,
        'INV-' || cast(l_orderkey AS varchar(20)) || '-' || cast(l_linenumber AS varchar(20)) AS entity_id,
        CASE l_orderkey % 4 WHEN 0 THEN 'status' WHEN 1 THEN 'amount' WHEN 2 THEN 'invoice_date' ELSE 'customer_id'
          END AS field_corrected,
        'old' AS old_value,
        CASE l_orderkey % 4 WHEN 1 THEN '42.00' ELSE 'void' END AS new_value,
        'reason' AS reason,
        '2024-03-15T10:00:00Z' AS corrected_at,
        'user' AS corrected_by
        FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) t
    """,
}
