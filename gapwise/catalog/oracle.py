"""The same results in SQL, for checking against another engine.

Each text is written from the rule and not from the plan: correlated EXISTS and
scalar subqueries where the plans use joins.
"""

from __future__ import annotations

BASIC = {
    "scan_rename": """
        SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS segment
        FROM customer""",
    "nested_record_flatten": """
        SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""",
    "nested_prescriber": """
        SELECT c_custkey, 'D' || c_custkey AS pbr_dea_id,
               CASE WHEN c_custkey % 3 <> 0 THEN CAST(c_nationkey AS VARCHAR) END AS pbr_npi,
               c_name AS pbr_first_nm, CAST(NULL AS VARCHAR) AS pbr_mid_init_nm,
               c_mktsegment AS pbr_last_nm
        FROM customer""",
    "nested_reject_code": """
        SELECT p_partkey, p_size AS dxf_sk, p_brand AS rej_cd,
               CASE WHEN p_partkey % 5 <> 0 THEN p_type END AS rej_cd_desc,
               CAST(NULL AS VARCHAR) AS src_env_sk
        FROM part""",
    "filter_in_list": """
        SELECT o_orderkey, o_orderpriority FROM orders
        WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""",
    "filter_constant_eq": """
        SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem
        WHERE l_returnflag = 'A' AND l_linenumber = 1""",
    "filter_time_range": """
        SELECT o_orderkey, o_orderdate FROM orders
        WHERE o_orderdate >= TIMESTAMP '1996-01-01 00:00:00'
          AND o_orderdate < TIMESTAMP '1997-01-01 00:00:00'""",
    "filter_time_range_inclusive": """
        SELECT event_id, ts FROM events
        WHERE ts BETWEEN TIMESTAMP '2024-01-02 00:00:00' AND TIMESTAMP '2024-01-03 23:59:59'""",
    "filter_null_tests": """
        SELECT c_custkey, o_orderkey IS NULL AS is_missing, o_orderkey IS NOT NULL AS is_present
        FROM customer LEFT JOIN orders
          ON o_custkey = c_custkey AND o_orderstatus = 'F' AND o_totalprice > 400000
        WHERE o_orderkey IS NULL OR c_mktsegment IS NOT NULL""",
    "usable_id_predicate": """
        SELECT c_custkey, nullif(c_custkey % 5, 3) AS number,
               (nullif(c_custkey % 5, 3) IS NULL OR nullif(c_custkey % 5, 3) < 1) AS is_unusable
        FROM customer""",
    "case_searched": """
        SELECT l_orderkey, l_linenumber, l_partkey,
               CASE WHEN l_returnflag = 'A' THEN 'returned'
                    WHEN l_linestatus = 'O' AND l_quantity > 25 THEN 'open large'
                    ELSE CASE WHEN l_linestatus = 'O' THEN 'open'
                              WHEN l_quantity > 40 THEN 'large' END END AS label
        FROM lineitem""",
    "coalesce_chain": """
        SELECT o_orderkey,
               COALESCE(CASE WHEN o_orderkey % 7 = 0 THEN 'seven' END,
                        CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_orderkey AS VARCHAR) END,
                        CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END,
                        'none') AS status
        FROM orders""",
    "scalar_functions": """
        SELECT o_orderkey,
               CAST(o_orderdate AS DATE) + INTERVAL '13 hours 14 minutes 15 seconds' AS parsed_at,
               CAST(date_diff('second', o_orderdate, TIMESTAMP '2001-08-02 00:00:00') AS BIGINT) AS age,
               'K' || o_orderkey || '|' AS joined,
               o_orderstatus || ' ' || o_orderpriority AS words,
               CAST(len(string_split(o_orderpriority, '-')) AS INTEGER) AS n_words,
               TRY_CAST(string_split(o_orderpriority, '-')[1] AS BIGINT) AS priority,
               TRY_CAST(string_split(o_orderpriority, '-')[2] AS BIGINT) AS no_number
        FROM orders""",
    "inner_equi_join": """
        SELECT o_orderkey, o_custkey, n_name
        FROM orders JOIN customer ON c_custkey = o_custkey
        JOIN nation ON n_nationkey = c_nationkey""",
    "left_outer_join": """
        SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON o_custkey = c_custkey""",
    "left_join_on_filter": """
        SELECT c_custkey, o_orderkey, o_orderstatus FROM customer LEFT JOIN orders
          ON o_custkey = c_custkey AND o_orderstatus = 'F' AND o_totalprice > 400000""",
    "two_hop_absence": """
        SELECT DISTINCT c_custkey FROM customer
        LEFT JOIN orders ON o_custkey = c_custkey
        LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_quantity > 49
        GROUP BY c_custkey HAVING count(l_orderkey) = 0""",
    "exists_flag": """
        SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey
                                  AND o_orderpriority = '1-URGENT') AS has_urgent
        FROM customer""",
    "not_exists": """
        SELECT o_orderkey, o_custkey FROM orders
        WHERE NOT EXISTS (SELECT 1 FROM lineitem
                          WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')""",
    "unique_lookup": """
        SELECT o_orderkey, o_custkey,
               (SELECT c_name FROM customer WHERE c_custkey = o_custkey) AS c_name
        FROM orders""",
    "first_match_lookup": """
        SELECT c_custkey, o_orderkey, o_orderstatus
        FROM customer LEFT JOIN (
          SELECT *, row_number() OVER (PARTITION BY o_custkey
                                       ORDER BY o_orderdate, o_orderkey) AS rn FROM orders
        ) o ON o_custkey = c_custkey AND rn = 1""",
    "count_zero_flag": """
        SELECT c_custkey, (SELECT count(*) FROM orders
                           WHERE o_custkey = c_custkey AND o_orderstatus = 'F') = 0 AS has_none
        FROM customer""",
    "or_key_join": """
        SELECT c_custkey, o_orderkey, o_custkey FROM customer LEFT JOIN orders
          ON c_custkey = o_custkey OR c_custkey = o_orderkey""",
    "left_join_where_right": """
        SELECT c_custkey, o_orderkey, o_orderstatus
        FROM customer LEFT JOIN orders ON o_custkey = c_custkey WHERE o_orderstatus = 'F'""",
    "state_gated_join": """
        SELECT c_custkey, c_mktsegment, c_nationkey, n_name
        FROM customer LEFT JOIN nation
          ON c_mktsegment = 'BUILDING' AND n_nationkey = c_nationkey""",
    "star_inner_join": """
        SELECT o_orderkey, o_orderstatus, returned_part, refused_supplier, kept_line
        FROM orders
        JOIN (SELECT l_orderkey AS k, l_partkey AS returned_part FROM lineitem
              WHERE l_returnflag = 'A') a ON a.k = o_orderkey
        JOIN (SELECT l_orderkey AS k, l_suppkey AS refused_supplier FROM lineitem
              WHERE l_returnflag = 'R') r ON r.k = o_orderkey
        JOIN (SELECT l_orderkey AS k, l_linenumber AS kept_line FROM lineitem
              WHERE l_returnflag = 'N') n ON n.k = o_orderkey""",
    "grouped_count_status": """
        SELECT c_custkey, count(o_orderkey) AS n_orders,
               CASE WHEN count(o_orderkey) = 0 THEN 'No large order' ELSE 'Exists' END AS status
        FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_totalprice > 300000
        GROUP BY c_custkey""",
    "grouped_concat": """
        SELECT l_orderkey,
               string_agg(CAST(l_partkey AS VARCHAR), ' ' ORDER BY l_linenumber, l_partkey) AS parts
        FROM lineitem WHERE l_returnflag = 'A' GROUP BY l_orderkey""",
}

# Elements of the array records as rows, in their order.
_ELEMENTS = """
    WITH element AS (
      SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, l_linestatus,
             l_linenumber + CASE WHEN l_orderkey % 4 = 0 THEN 5 ELSE 0 END AS cntr,
             CASE l_returnflag WHEN 'A' THEN 's' WHEN 'N' THEN 'H' ELSE 'x' END AS resp,
             CASE WHEN l_linestatus = 'O' THEN 'MEDLIMIT' ELSE 'OTHER' END AS service,
             CASE l_partkey % 4 WHEN 0 THEN 'HD' WHEN 1 THEN 'HC' WHEN 2 THEN 'MX' ELSE 'ZZ' END
               AS reason
      FROM lineitem
    )"""
_IN_ORDER = "ORDER BY l_linenumber, l_partkey, l_returnflag, l_linestatus"


def _texts(match: str, sep: str = " ") -> str:
    def text(column: str, name: str) -> str:
        return (
            f"COALESCE(string_agg(CAST({column} AS VARCHAR) || '{sep}', '' {_IN_ORDER}) "
            f"FILTER (WHERE {match}), '') AS {name}"
        )

    return ", ".join(
        [text("cntr", "service_seq"), text("resp", "resp_flags"), text("reason", "reason_codes")]
    )


def _flags(match: str) -> str:
    def flag(rule: str, name: str) -> str:
        return f"CASE WHEN count(*) FILTER (WHERE {match} AND {rule}) > 0 THEN 'Y' ELSE '' END AS {name}"

    return ", ".join(
        [
            flag("resp = 's' AND reason IN ('HD', 'HC')", "c_e_flag"),
            flag("resp = 'H' AND reason = 'HD'", "q_r_flag"),
            flag("resp = 'H' AND reason = 'MX'", "w_aa_flag"),
        ]
    )


_SERVICE = "service = 'MEDLIMIT'"
ARRAYS = {
    "array_match_concat": f"{_ELEMENTS} SELECT l_orderkey, {_texts(_SERVICE)} FROM element GROUP BY 1",
    "array_match_flags": f"{_ELEMENTS} SELECT l_orderkey, {_flags(_SERVICE)} FROM element GROUP BY 1",
    "array_scan_scalar_service": f"""{_ELEMENTS}
        SELECT l_orderkey, {_texts("l_orderkey % 3 <> 0", "|")}, {_flags("l_orderkey % 3 <> 0")}
        FROM element GROUP BY 1""",
    "struct_unpack": f"""{_ELEMENTS}
        SELECT l_orderkey, {_texts(_SERVICE)}, {_flags(_SERVICE)} FROM element GROUP BY 1""",
    "array_slot_placement": f"""{_ELEMENTS},
      placed AS (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, cntr
          ORDER BY l_linenumber DESC, l_partkey DESC, l_returnflag DESC, l_linestatus DESC) AS rn
        FROM element
      ),
      slots AS (
        SELECT l_orderkey, slot FROM (SELECT DISTINCT l_orderkey FROM lineitem),
               (SELECT CAST(unnest(range(1, 11)) AS INTEGER) AS slot)
      )
      SELECT s.l_orderkey, s.slot, p.resp, p.service, p.reason AS reason_service
      FROM slots s LEFT JOIN placed p
        ON p.l_orderkey = s.l_orderkey AND p.cntr = s.slot AND p.rn = 1""",
    "row_flags": f"""{_ELEMENTS}
        SELECT l_orderkey, l_linenumber, l_partkey, resp, service, reason AS reason_service,
          CASE WHEN resp = 's' AND reason IN ('HD', 'HC') THEN 'Y' ELSE '' END AS c_e_flag,
          CASE WHEN resp = 'H' AND reason = 'HD' THEN 'Y' ELSE '' END AS q_r_flag,
          CASE WHEN resp = 'H' AND reason = 'MX' THEN 'Y' ELSE '' END AS w_aa_flag
        FROM element""",
}

_WORDS = """
    WITH word AS (
      SELECT doc_id, unnest(string_split(text, ' ')) AS w,
             generate_subscripts(string_split(text, ' '), 1) AS pos
      FROM documents
    ),
    element AS (
      SELECT doc_id, pos, length(w) AS cntr, substring(w, 1, 1) AS resp,
             CASE WHEN length(w) % 2 = 0 THEN 'MEDLIMIT' ELSE 'OTHER' END AS service,
             CASE (length(w) // 2) % 4 WHEN 0 THEN 'HD' WHEN 1 THEN 'HC' WHEN 2 THEN 'MX'
                  ELSE 'ZZ' END AS reason
      FROM word
    )"""
ARRAYS["array_scan_words"] = f"""{_WORDS}
    SELECT doc_id, {_texts(_SERVICE).replace(_IN_ORDER, "ORDER BY pos")}, {_flags(_SERVICE)}
    FROM element GROUP BY 1"""

# The derived tables.
_DERIVED = """
    WITH o AS (
      SELECT o_orderkey AS k, o_orderkey // 2 AS j, o_orderkey % 2 = 0 AS even,
             o_custkey AS cust, o_orderpriority, o_orderdate FROM orders
    ),
    ct AS (
      SELECT l_orderkey * 10 + l_linenumber AS c, l_orderkey + l_linenumber AS s,
             min(l_partkey) AS partkey
      FROM lineitem WHERE l_orderkey % 2 = 1 OR (l_orderkey // 2) % 17 = 0
      GROUP BY l_orderkey, l_linenumber
    ),
    n AS (SELECT DISTINCT p_partkey AS n FROM part),
    asset AS (
      SELECT k AS asset_id, 'SN' || k AS serial_num, cust % 50 AS manufacturer_id,
             o_orderpriority AS item_class,
             CAST(CASE WHEN j % 23 = 0 THEN NULL WHEN j % 3 = 0 THEN 6 ELSE 1 END AS INTEGER) AS source_site_id,
             CASE j % 7 WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE cust + 1 END AS customer_num,
             CASE WHEN even THEN 99999 ELSE k END AS order_num,
             CASE j % 4 WHEN 0 THEN 'PGM.A' WHEN 1 THEN 'PGM.B' WHEN 2 THEN 'PGM.C'
                        ELSE 'OTHER' END AS create_pgm,
             o_orderdate AS created_at
      FROM o
    ),
    asset_relationship AS (
      SELECT k AS from_asset_id, k + 1 AS to_asset_id,
             CASE WHEN j % 11 = 0 THEN 4 ELSE 9 END AS relationship_type_id
      FROM o WHERE even
      UNION ALL SELECT k, k + 3, 9 FROM o WHERE even AND j % 14 = 3
    ),
    contract AS (
      SELECT c AS contract_id, 'IT' || partkey AS item_num,
             CAST(CASE WHEN s % 19 = 0 THEN NULL WHEN s % 4 = 0 THEN 6 ELSE 1 END AS INTEGER) AS source_site_id
      FROM ct
    ),
    contract_coverage AS (
      SELECT c AS contract_id, c // 10 AS asset_id FROM ct
      UNION ALL SELECT c, c // 10 + 2 FROM ct WHERE c % 10 = 4
      UNION ALL SELECT 90000000 + k, k FROM o WHERE even AND j % 13 = 0
    ),
    contract_identifier AS (
      SELECT c + 5000000 AS contract_id, CASE WHEN c % 21 = 0 THEN 'C-' || c ELSE CAST(c AS VARCHAR) END AS identifier_value,
             CASE WHEN c % 2 = 0 THEN 106 ELSE 105 END AS identifier_type_id
      FROM ct WHERE c % 7 = 0
    ),
    agreement AS (
      SELECT 2000000 + k AS agreement_id,
             CAST(CASE WHEN j % 17 = 0 THEN NULL WHEN j % 3 = 0 THEN 6 ELSE 1 END AS INTEGER) AS source_site_id
      FROM o WHERE even
      UNION ALL
      SELECT 1000000 + k, CAST(CASE WHEN j % 17 = 0 THEN NULL WHEN j % 2 = 0 THEN 6 ELSE 1 END AS INTEGER)
      FROM o WHERE NOT even
    ),
    agreement_contract AS (
      SELECT 1000000 + c // 10 AS agreement_id, c AS contract_id FROM ct WHERE c % 10 <= 4
      UNION ALL SELECT 1000000 + c // 10 + 2, c FROM ct WHERE c % 10 = 3
      UNION ALL SELECT 2000000 + k, 90000000 + k FROM o WHERE even
      UNION ALL SELECT 2000000 + k, 91000000 + k FROM o WHERE even AND j % 6 = 1
    ),
    agreement_identifier AS (
      SELECT 1000000 + k AS agreement_id,
             CAST(CASE j % 9 WHEN 0 THEN 110 WHEN 1 THEN 112 ELSE 111 END AS INTEGER)
               AS identifier_type_id,
             CAST(2000000 + k - 1 AS VARCHAR) AS identifier_value
      FROM o WHERE NOT even
      UNION ALL
      SELECT 1000000 + k, 112, CAST(2000000 + k + 1 AS VARCHAR)
      FROM o WHERE NOT even AND j % 12 = 5
      UNION ALL SELECT 1000000 + k, 111, 'A' || k FROM o WHERE NOT even AND j % 10 = 7
    ),
    agreement_asset AS (
      SELECT 2000000 + k AS agreement_id, CASE WHEN j % 5 = 1 THEN k + 2 ELSE k END AS asset_id
      FROM o WHERE even AND j % 5 <> 0
      UNION ALL SELECT 1000000 + k, k FROM o WHERE NOT even AND j % 5 <> 2
      UNION ALL SELECT 2000000 + k, k + 4 FROM o WHERE even AND j % 5 <> 0 AND j % 7 = 3
    ),
    party_address AS (
      SELECT k AS party_address_id,
             CASE j % 6 WHEN 1 THEN 0 WHEN 2 THEN NULL ELSE cust + 1 END AS customer_num,
             CASE j % 9 WHEN 3 THEN NULL WHEN 6 THEN 0 ELSE cust + 1000 END AS ucid
      FROM o WHERE even
    ),
    party_address_agreement AS (
      SELECT k AS party_address_id, 2000000 + k AS agreement_id FROM o WHERE even AND j % 8 <> 0
      UNION ALL SELECT k + 2, 2000000 + k FROM o WHERE even AND j % 8 <> 0 AND j % 5 = 2
    ),
    party_address_asset AS (
      SELECT k AS party_address_id, k AS asset_id FROM o WHERE even AND j % 8 <> 1
      UNION ALL SELECT k + 4, k FROM o WHERE even AND j % 8 <> 1 AND j % 7 = 2
    ),
    item_mapping AS (
      SELECT 'IT' || n AS item_num_a, 'IT' || (n + 1) AS item_num_b,
             CASE WHEN n % 10 = 3 THEN 34 ELSE 33 END AS application_id,
             1 + n % 6 AS map_type_id
      FROM n
    ),
    item_main AS (
      SELECT 'IT' || n AS item_num, CASE WHEN n % 2 = 0 THEN 6 ELSE 1 END AS source_site_id FROM n
    ),
    instruction AS (
      SELECT c AS instr_id, 1 + c % 2 AS entity_type_id,
             CASE WHEN c % 11 = 0 THEN 'none' ELSE CAST(c AS VARCHAR) END AS entity_value
      FROM ct WHERE c % 5 < 2
    )"""

_STEPS = (
    _DERIVED
    + """,
    candidate AS (
      SELECT asset_id, serial_num, manufacturer_id, item_class, source_site_id AS site, customer_num
      FROM asset a
      WHERE create_pgm IN ('PGM.A', 'PGM.B', 'PGM.C') AND order_num = 99999
        AND created_at >= TIMESTAMP '1996-01-01 00:00:00'
        AND created_at < TIMESTAMP '2001-01-01 00:00:00'
        AND NOT EXISTS (SELECT 1 FROM contract_coverage v JOIN contract USING (contract_id)
                        WHERE v.asset_id = a.asset_id)
    ),
    original AS (
      SELECT c.*, r.to_asset_id AS original_asset_id
      FROM candidate c LEFT JOIN asset_relationship r
        ON r.from_asset_id = c.asset_id AND r.relationship_type_id = 9
    ),
    reached AS (
      SELECT DISTINCT o.asset_id, o.original_asset_id, t.contract_id
      FROM original o JOIN contract_coverage v ON v.asset_id = o.original_asset_id JOIN contract t USING (contract_id)
    ),
    found AS (
      SELECT c.*, (SELECT min(original_asset_id) FROM reached r WHERE r.asset_id = c.asset_id AND r.contract_id = t.contract_id)
               AS original_asset_id,
             t.contract_id, t.item_num, t.source_site_id AS contract_site
      FROM candidate c JOIN (SELECT DISTINCT asset_id, contract_id FROM reached) p USING (asset_id)
      JOIN contract t USING (contract_id)
      UNION ALL
      SELECT c.*, (SELECT min(original_asset_id) FROM original o WHERE o.asset_id = c.asset_id), NULL, NULL, NULL
      FROM candidate c WHERE NOT EXISTS (SELECT 1 FROM reached r WHERE r.asset_id = c.asset_id)
    ),
    checked AS (
      SELECT f.*,
        (SELECT min(agreement_id) FROM agreement_contract x WHERE x.contract_id = f.contract_id)
          AS agreement_id,
        EXISTS (SELECT 1 FROM contract_identifier i WHERE i.identifier_type_id = 106
                AND TRY_CAST(i.identifier_value AS BIGINT) = f.contract_id) AS dual,
        EXISTS (SELECT 1 FROM instruction i WHERE i.entity_type_id = 1
                AND TRY_CAST(i.entity_value AS BIGINT) = f.contract_id) AS instructed,
        COALESCE(item_num IN ('IT0', 'IT7', 'IT14', 'IT21', 'IT28'), FALSE) AS listed,
        (SELECT max(CASE WHEN f.contract_site = 6 THEN m.item_num_a ELSE m.item_num_b END)
         FROM item_mapping m WHERE m.application_id = 33 AND m.map_type_id IN (1, 3, 4, 5, 6)
           AND CASE WHEN f.contract_site = 6 THEN m.item_num_a ELSE m.item_num_b END = f.item_num)
          AS mapped_item
      FROM found f
    ),
    counterpart AS (
      SELECT c.*,
        (SELECT min(TRY_CAST(identifier_value AS BIGINT)) FROM agreement_identifier i
         WHERE i.agreement_id = c.agreement_id AND i.identifier_type_id IN (111, 112))
          AS cp_agreement_id,
        EXISTS (SELECT 1 FROM item_main g WHERE g.item_num = c.mapped_item
                AND CASE WHEN c.contract_site = 6 THEN g.source_site_id <> 6
                         ELSE g.source_site_id = 6 END) AS main_found
      FROM checked c
    ),
    sited AS (
      SELECT c.*,
        (SELECT source_site_id FROM agreement a WHERE a.agreement_id = c.cp_agreement_id) AS cp_site,
        (SELECT min(contract_id) FROM agreement_contract a WHERE a.agreement_id = c.cp_agreement_id)
          AS cp_contract_id,
        EXISTS (SELECT 1 FROM agreement_asset a WHERE a.agreement_id = c.cp_agreement_id) AS any_asset,
        EXISTS (SELECT 1 FROM agreement_asset a WHERE a.agreement_id = c.cp_agreement_id
                AND a.asset_id = c.asset_id) AS this_asset
      FROM counterpart c
    ),
    located AS (
      SELECT s.*,
        EXISTS (SELECT 1 FROM party_address_agreement l JOIN party_address p USING (party_address_id)
                WHERE l.agreement_id = s.cp_agreement_id
                  AND (s.cp_site IS NULL OR (s.cp_site = 6 AND p.ucid >= 1)
                       OR (s.cp_site <> 6 AND p.customer_num >= 1))) AS located,
        EXISTS (SELECT 1 FROM party_address_asset l JOIN party_address p USING (party_address_id)
                WHERE l.asset_id = s.asset_id
                  AND (s.site IS NULL OR (s.site = 6 AND p.ucid >= 1)
                       OR (s.site <> 6 AND p.customer_num >= 1)))
          OR COALESCE(s.customer_num, 0) >= 1 AS customer_ok
      FROM sited s
    ),
    report AS (
      SELECT asset_id, serial_num, manufacturer_id, item_class, site, customer_num,
        original_asset_id, contract_id, item_num, contract_site,
        CASE WHEN contract_id IS NOT NULL THEN dual END AS is_dual_serialized,
        CASE WHEN contract_id IS NOT NULL THEN listed END AS is_ineligible_item,
        agreement_id, cp_agreement_id, cp_site, cp_contract_id,
        CASE WHEN cp_agreement_id IS NOT NULL THEN any_asset END AS has_any_asset,
        CASE WHEN cp_agreement_id IS NOT NULL THEN this_asset END AS has_this_asset,
        CASE WHEN cp_agreement_id IS NOT NULL THEN located END AS location_ok,
        customer_ok, mapped_item,
        CASE WHEN mapped_item IS NOT NULL THEN main_found END AS has_main_item,
        CASE WHEN contract_id IS NOT NULL THEN instructed END AS has_instruction,
        CASE
          WHEN original_asset_id IS NULL THEN 'Original asset not found'
          WHEN contract_id IS NULL THEN 'Original Asset Without Entitlement'
          WHEN dual THEN 'Original entitlement dual serialized to different asset'
          WHEN listed THEN 'SKU not eligible'
          WHEN agreement_id IS NOT NULL AND cp_agreement_id IS NULL
            THEN 'CounterPart Agreement Not Found'
          WHEN agreement_id IS NOT NULL AND NOT any_asset
            THEN 'Missing Agreement/Asset Relationship'
          WHEN agreement_id IS NOT NULL AND NOT this_asset
            THEN 'CounterPart Agreement Linked to Non-Mapped Asset'
          WHEN agreement_id IS NOT NULL AND NOT located THEN 'PartyLocation not found'
          WHEN agreement_id IS NULL AND NOT customer_ok
            THEN 'Customer not found in counterpart asset'
          WHEN mapped_item IS NULL THEN 'Missing Item Material Mapping'
          WHEN NOT main_found THEN 'Missing Global Item Main'
          WHEN instructed THEN 'Instruction in Error'
          WHEN agreement_id IS NOT NULL THEN '[AGREEMENT] Other'
          ELSE 'Other' END AS root_cause
      FROM located
    )"""
)


def _bridge(key: str) -> str:
    return (
        _DERIVED
        + f"""
      SELECT i.identifier_value AS cp_agreement_id, i.agreement_id, i.identifier_type_id,
             a.source_site_id AS cp_site, c.contract_id AS cp_contract_id,
             s.asset_id AS cp_asset_id
      FROM agreement_identifier i
      JOIN agreement a ON a.agreement_id = {key}
      JOIN agreement_contract c ON c.agreement_id = {key}
      JOIN agreement_asset s ON s.agreement_id = {key}
      WHERE i.identifier_type_id IN (111, 112)"""
    )


_PER_CONTRACT = "FROM report WHERE contract_id IS NOT NULL"

ANALYSIS = {
    "filter_ne_three_valued": _DERIVED
    + """
      SELECT agreement_id, contract_id, source_site_id, source_site_id <> 6 AS ne_result
      FROM agreement_contract LEFT JOIN agreement USING (agreement_id)
      WHERE source_site_id IS DISTINCT FROM 6""",
    "and_or_grouped_predicate": _DERIVED
    + """
      SELECT a.agreement_id, p.party_address_id, a.source_site_id
      FROM party_address_agreement l JOIN party_address p USING (party_address_id)
      JOIN agreement a ON a.agreement_id = l.agreement_id
      WHERE (a.source_site_id = 6 AND (p.ucid IS NULL OR p.ucid < 1))
         OR (a.source_site_id <> 6 AND (p.customer_num IS NULL OR p.customer_num < 1))""",
    "not_exists_two_keys": _DERIVED
    + """
      SELECT DISTINCT c.agreement_id, v.asset_id
      FROM agreement_contract c JOIN contract_coverage v USING (contract_id)
      WHERE NOT EXISTS (SELECT 1 FROM agreement_asset s
                        WHERE s.agreement_id = c.agreement_id AND s.asset_id = v.asset_id)""",
    "nested_lookup": _DERIVED
    + """,
      hop AS (
        SELECT contract_id, (SELECT min(agreement_id) FROM agreement_contract a
                             WHERE a.contract_id = t.contract_id) AS agreement_id
        FROM contract t
      )
      SELECT contract_id, agreement_id,
             (SELECT min(TRY_CAST(identifier_value AS BIGINT)) FROM agreement_identifier i
              WHERE i.agreement_id = hop.agreement_id AND i.identifier_type_id IN (111, 112))
               AS cp_agreement_id
      FROM hop""",
    "two_key_column_lookup": _DERIVED
    + """
      SELECT contract_id, item_num,
             CASE WHEN EXISTS (
               SELECT 1 FROM item_mapping m
               WHERE CASE WHEN t.source_site_id = 6 THEN m.item_num_a ELSE m.item_num_b END
                     = t.item_num) THEN item_num END AS mapped_item
      FROM contract t""",
    "wide_left_assembly": _DERIVED
    + """
      SELECT contract_id, item_num, n_assets, n_identifiers, n_agreements, n_instructions
      FROM contract
      LEFT JOIN (SELECT contract_id, count(*) AS n_assets FROM contract_coverage GROUP BY 1)
        USING (contract_id)
      LEFT JOIN (SELECT TRY_CAST(identifier_value AS BIGINT) AS contract_id, count(*) AS n_identifiers
                 FROM contract_identifier GROUP BY 1) USING (contract_id)
      LEFT JOIN (SELECT contract_id, count(*) AS n_agreements FROM agreement_contract GROUP BY 1)
        USING (contract_id)
      LEFT JOIN (SELECT TRY_CAST(entity_value AS BIGINT) AS contract_id, count(*) AS n_instructions
                 FROM instruction GROUP BY 1) USING (contract_id)""",
    "assets_without_contract": _STEPS + " SELECT * FROM candidate",
    "original_asset": _STEPS + " SELECT * FROM original",
    "original_contracts": _STEPS
    + " SELECT asset_id, original_asset_id, contract_id, item_num, contract_site FROM found",
    "contract_preclass": _STEPS
    + f"""
      SELECT DISTINCT contract_id, item_num, contract_site, is_dual_serialized, is_ineligible_item
      {_PER_CONTRACT}""",
    "counterpart_agreement": _STEPS
    + f" SELECT DISTINCT contract_id, agreement_id, cp_agreement_id {_PER_CONTRACT}",
    "counterpart_agreement_attrs": _STEPS
    + " SELECT DISTINCT cp_agreement_id, cp_site FROM report WHERE cp_agreement_id IS NOT NULL",
    "counterpart_agreement_contracts": _STEPS
    + """
      SELECT DISTINCT r.cp_agreement_id, a.contract_id AS cp_contract_id
      FROM report r LEFT JOIN agreement_contract a ON a.agreement_id = r.cp_agreement_id
      WHERE r.cp_agreement_id IS NOT NULL""",
    "agreement_asset_check": _STEPS
    + f"""
      SELECT asset_id, contract_id, cp_agreement_id, has_any_asset, has_this_asset
      {_PER_CONTRACT}""",
    "party_location_check": _STEPS
    + """
      SELECT DISTINCT cp_agreement_id, cp_site, location_ok FROM report
      WHERE cp_agreement_id IS NOT NULL""",
    "customer_check": _STEPS
    + " SELECT DISTINCT asset_id, site, customer_num, customer_ok FROM report",
    "item_mapping_check": _STEPS
    + f" SELECT DISTINCT contract_id, item_num, contract_site, mapped_item {_PER_CONTRACT}",
    "item_main_check": _STEPS
    + f"""
      SELECT DISTINCT contract_id, item_num, contract_site, mapped_item, has_main_item
      {_PER_CONTRACT}""",
    "instruction_check": _STEPS
    + f" SELECT DISTINCT contract_id, has_instruction {_PER_CONTRACT}",
    "root_cause_ladder": _STEPS + " SELECT asset_id, contract_id, root_cause FROM report",
    "root_cause_report": _STEPS + " SELECT * FROM report",
    "status_coalesce": _STEPS
    + """
      SELECT asset_id, serial_num, manufacturer_id, item_class, site, customer_num,
             contract_id, item_num,
             CASE WHEN contract_id IS NOT NULL THEN COALESCE(
               CASE WHEN (SELECT count(*) FROM party_address_agreement l
                          WHERE l.agreement_id = r.cp_agreement_id) = 0
                    THEN 'PartyLocation not found' END,
               CASE WHEN cp_agreement_id IS NULL THEN 'CounterPart Agreement Not Found' END,
               CASE WHEN (SELECT count(*) FROM item_mapping m
                          WHERE (m.item_num_a = r.item_num OR m.item_num_b = r.item_num)
                            AND m.application_id = 33 AND m.map_type_id IN (1, 3, 4, 5, 6)) = 0
                    THEN 'Missing Item Material Mapping' END,
               CASE WHEN (SELECT count(*) FROM item_main g WHERE g.item_num = r.item_num) = 0
                    THEN 'Missing Global Item Main' END,
               'Other') END AS root_cause
      FROM report r""",
    "staged_agreement_flow": _STEPS
    + """,
      of_agreement AS (
        SELECT DISTINCT agreement_id AS a_id, 'contract' AS stage, contract_id AS record_id,
               CAST(NULL AS BIGINT) AS customer_num, CAST(NULL AS BIGINT) AS ucid
        FROM agreement_contract
        UNION ALL SELECT DISTINCT agreement_id, 'asset', asset_id, NULL, NULL FROM agreement_asset
        UNION ALL SELECT DISTINCT l.agreement_id, 'location', p.party_address_id, p.customer_num, p.ucid
        FROM party_address_agreement l JOIN party_address p USING (party_address_id)
      ),
      of_asset AS (
        SELECT DISTINCT l.asset_id AS a_id, p.party_address_id AS record_id, p.customer_num, p.ucid
        FROM party_address_asset l JOIN party_address p USING (party_address_id)
      ),
      flow AS (
        SELECT r.*, 'agreement' AS stage, cp_agreement_id AS record_id, cp_agreement_id AS link,
               CAST(NULL AS BIGINT) AS address_num, CAST(NULL AS BIGINT) AS ucid
        FROM report r WHERE contract_id IS NOT NULL
        UNION ALL
        SELECT r.*, s.stage, a.record_id, a.a_id, a.customer_num, a.ucid
        FROM report r CROSS JOIN (VALUES ('contract'), ('asset'), ('location')) s (stage)
        LEFT JOIN of_agreement a ON a.a_id = r.cp_agreement_id AND a.stage = s.stage
        WHERE r.cp_agreement_id IS NOT NULL
        UNION ALL
        SELECT r.*, 'customer', a.record_id, NULL, a.customer_num, a.ucid
        FROM report r LEFT JOIN of_asset a ON a.a_id = r.asset_id
        UNION ALL
        SELECT r.*, 'mapping', NULL, NULL, NULL, NULL FROM report r WHERE contract_id IS NOT NULL
      )
      SELECT asset_id, original_asset_id, contract_id, agreement_id, cp_agreement_id, stage, record_id,
             link AS record_agreement_id,
             CASE WHEN stage = 'agreement' THEN cp_site END AS site,
             address_num AS customer_num, ucid,
             CASE WHEN stage = 'mapping' THEN mapped_item END AS item_num,
             CASE stage
               WHEN 'asset' THEN COALESCE(record_id = asset_id, FALSE)
               WHEN 'location' THEN record_id IS NOT NULL AND (cp_site IS NULL
                 OR COALESCE(CASE WHEN cp_site = 6 THEN ucid ELSE address_num END, 0) >= 1)
               WHEN 'customer' THEN record_id IS NOT NULL AND (site IS NULL
                 OR COALESCE(CASE WHEN site = 6 THEN ucid ELSE address_num END, 0) >= 1)
               WHEN 'mapping' THEN mapped_item IS NOT NULL
               ELSE record_id IS NOT NULL END AS fits,
             CASE
               WHEN stage = 'agreement' AND record_id IS NULL THEN 'CounterPart Agreement Not Found'
               WHEN stage = 'asset' AND NOT has_any_asset THEN 'Missing Agreement/Asset Relationship'
               WHEN stage = 'asset' AND NOT has_this_asset
                 THEN 'CounterPart Agreement Linked to Non-Mapped Asset'
               WHEN stage = 'location' AND NOT location_ok THEN 'PartyLocation not found'
               WHEN stage = 'customer' AND NOT customer_ok
                 THEN 'Customer not found in counterpart asset'
               WHEN stage = 'mapping' AND mapped_item IS NULL THEN 'Missing Item Material Mapping'
             END AS label
      FROM flow""",
    "staged_agreement_summary": _STEPS
    + """,
      cp_first AS (
        SELECT l.agreement_id AS a_id, p.*,
               row_number() OVER (PARTITION BY l.agreement_id ORDER BY p.party_address_id) AS rn
        FROM party_address_agreement l JOIN party_address p USING (party_address_id)
      ),
      asset_first AS (
        SELECT l.asset_id AS a_id, p.*,
               row_number() OVER (PARTITION BY l.asset_id ORDER BY p.party_address_id) AS rn
        FROM party_address_asset l JOIN party_address p USING (party_address_id)
      )
      SELECT r.asset_id, r.serial_num, r.manufacturer_id, r.item_class, r.site, r.customer_num,
             r.original_asset_id, r.contract_id, r.item_num, r.contract_site, r.agreement_id,
             r.cp_agreement_id,
             CASE WHEN r.contract_id IS NOT NULL AND r.cp_agreement_id IS NULL
                  THEN 'CounterPart Agreement Not Found' END AS agreement_label,
             r.cp_site, r.cp_contract_id,
             CASE WHEN NOT has_any_asset THEN 'Missing Agreement/Asset Relationship'
                  WHEN NOT has_this_asset
                  THEN 'CounterPart Agreement Linked to Non-Mapped Asset' END AS source_label,
             c.party_address_id AS cp_address_id, c.customer_num AS cp_address_customer_num,
             c.ucid AS cp_address_ucid,
             CASE WHEN NOT location_ok THEN 'PartyLocation not found' END AS location_label,
             s.party_address_id AS asset_address_id,
             s.customer_num AS asset_address_customer_num, s.ucid AS asset_address_ucid,
             CASE WHEN NOT customer_ok THEN 'Customer not found in counterpart asset' END
               AS customer_label,
             r.mapped_item
      FROM report r
      LEFT JOIN cp_first c ON c.a_id = r.cp_agreement_id AND c.rn = 1
      LEFT JOIN asset_first s ON s.a_id = r.asset_id AND s.rn = 1""",
    "agreement_bridge": _bridge("i.agreement_id"),
    "agreement_bridge_by_value": _bridge("TRY_CAST(i.identifier_value AS BIGINT)"),
}

SQL = BASIC | ARRAYS | ANALYSIS
