"""DuckDB SQL for each query, written against the given tables only.

``field_status`` and its relatives repeat one expression per column, so those
parts are generated from short lists below; the rest is plain SQL.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {}

# --- common table expressions -------------------------------------------------------

FILES = """
files AS (
  SELECT doc_id,
    concat('/intake/', source, '/', lang, '/doc_', CAST(doc_id AS VARCHAR),
      CASE doc_id % 6 WHEN 0 THEN '.pdf' WHEN 1 THEN '.PDF' WHEN 2 THEN '.jpg'
                      WHEN 3 THEN '.png' WHEN 4 THEN '.txt' ELSE '' END) AS path,
    text,
    TIMESTAMP '2025-08-25 00:00:00' + doc_id * INTERVAL '1' HOUR AS modificationTime,
    TIMESTAMP '2025-09-20 00:00:00' AS ingestion_timestamp,
    n_chars AS length
  FROM documents),
ledger AS (SELECT path, modificationTime FROM files WHERE doc_id % 3 = 0)
"""

PENDING = """
pending AS (
  SELECT * FROM files f WHERE NOT EXISTS (
    SELECT 1 FROM ledger l WHERE l.path = f.path AND l.modificationTime = f.modificationTime))
"""

LINES = """
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
    l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate, l_returnflag, l_linestatus) AS rn
  FROM lineitem),
fx_lines AS (
  SELECT l_orderkey AS k, CAST(rn AS INTEGER) AS lineNumber,
    concat('P', lpad(CAST(l_partkey AS VARCHAR), 6, '0')) AS productCode,
    CASE l_partkey % 3 WHEN 0 THEN 'CASE' WHEN 1 THEN 'EACH' ELSE 'BOX' END AS uom,
    l_quantity AS quantityShipped, CAST(0.0 AS DOUBLE) AS weightShipped,
    l_extendedprice / l_quantity AS unitPrice, l_extendedprice AS lineTotal
  FROM numbered)
"""

HEADERS = """
per_order AS (
  SELECT o.*, m.sk
  FROM orders o LEFT JOIN (
    SELECT l_orderkey, min(l_suppkey) AS sk FROM lineitem GROUP BY l_orderkey) m
    ON m.l_orderkey = o.o_orderkey),
fx_header AS (
  SELECT o.o_orderkey AS k,
    concat('/intake/inv/', CAST(o.o_custkey % 10 AS VARCHAR), '/inv_', CAST(o.o_orderkey AS VARCHAR), '.pdf') AS source_file_path,
    concat('IN-', lpad(CAST(o.o_orderkey AS VARCHAR), 8, '0')) AS invoiceNumber,
    concat('SO-', lpad(CAST(o.o_orderkey AS VARCHAR), 6, '0')) AS orderNumber,
    lpad(CAST(o.o_custkey AS VARCHAR), 9, '0') AS purchaseOrderNumber,
    s.s_name AS vendorName,
    CASE WHEN o.o_orderkey % 5 = 0 THEN NULL ELSE CAST(s.s_suppkey AS VARCHAR) END AS vendorNumber,
    lpad(CAST(c.c_nationkey AS VARCHAR), 3, '0') AS branch,
    CASE WHEN o.o_orderkey % 13 = 0 THEN '7' ELSE lpad(CAST(o.o_custkey % 100 AS VARCHAR), 3, '0') END AS warehouse,
    CASE o.o_orderkey % 4
      WHEN 0 THEN strftime(o.o_orderdate, '%Y-%m-%d')
      WHEN 1 THEN strftime(o.o_orderdate, '%m/%d/%Y')
      WHEN 2 THEN concat(CAST(month(o.o_orderdate) AS VARCHAR), '/', CAST(day(o.o_orderdate) AS VARCHAR), '/',
                         CAST(year(o.o_orderdate) AS VARCHAR))
      ELSE 'pending' END AS invoiceDate,
    o.o_totalprice AS totalAmount,
    CAST(CASE WHEN o.o_orderkey % 17 = 0 THEN -1 ELSE 0 END AS DOUBLE) AS freightAmount,
    c.c_name AS shipping_address, n.n_name AS shipping_city,
    CASE n.n_regionkey WHEN 0 THEN 'CO' WHEN 1 THEN 'CA' WHEN 2 THEN 'Tx' ELSE 'NY' END AS shipping_state,
    lpad(CAST(o.o_custkey AS VARCHAR), 5, '0') AS shipping_zip,
    CAST(CASE WHEN o.o_orderkey % 3 = 0 THEN 30 ELSE NULL END AS INTEGER) AS termsNetDuedays
  FROM per_order o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN supplier s ON s.s_suppkey = o.sk)
"""


def strict_date(c: str) -> str:
    return (
        f"CASE WHEN regexp_matches({c}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$')"
        f" THEN CAST(try_strptime({c}, '%Y-%m-%d') AS DATE)"
        f" WHEN regexp_matches({c}, '^[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}$')"
        f" THEN CAST(try_strptime({c}, '%m/%d/%Y') AS DATE) END"
    )


def flat_of(source: str) -> str:
    """The flat layout of one source; columns it never fills are typed NULLs."""
    return f"""
  SELECT k, invoiceNumber, orderNumber, purchaseOrderNumber, vendorName, vendorNumber, branch, warehouse,
    totalAmount, freightAmount, subtotalAmount, shipping_address, shipping_city, shipping_state, shipping_zip,
    termsNetDuedays, source_file_path, raw_date,
    regexp_extract(source_file_path, '([^/]*)$', 1) AS source_file_name,
    regexp_extract(source_file_path, '^(.*/)[^/]+$', 1) AS source_volume_path,
    CAST(NULL AS VARCHAR) AS input, CAST(NULL AS VARCHAR) AS error, flags, summary, 'invoice' AS document_type,
    CAST(NULL AS VARCHAR) AS bolNumber, {strict_date('raw_date')} AS invoiceDate, CAST(NULL AS DATE) AS discountDate,
    CAST(NULL AS DOUBLE) AS discountAmount,
    CAST(NULL AS VARCHAR) AS remittance_address, CAST(NULL AS VARCHAR) AS remittance_city,
    CAST(NULL AS VARCHAR) AS remittance_state, CAST(NULL AS VARCHAR) AS remittance_zip,
    CAST(NULL AS DOUBLE) AS termsDiscountPercentage, CAST(NULL AS INTEGER) AS termsDiscountDueDays,
    items, CAST(to_json(items) AS VARCHAR) AS line_items_json,
    CAST(coalesce(len(items), 0) AS INTEGER) AS line_items_count, barcodes
  FROM {source}"""


_ITEM = (
    "{{'lineNumber': {number}, 'productCode': productCode, 'uom': uom, 'quantityShipped': quantityShipped,"
    " 'weightShipped': weightShipped, 'unitPrice': unitPrice, 'lineTotal': {total}}}"
)
_PLAIN_ITEM = _ITEM.format(number="lineNumber", total="lineTotal")
_CHANGED_ITEM = _ITEM.format(
    number="CAST(lineNumber + CASE WHEN k % 31 = 0 THEN 1 ELSE 0 END AS INTEGER)",
    total="lineTotal + CASE WHEN (k + lineNumber) % 29 = 0 THEN 1.0 ELSE 0.0 END",
)

EXTRACTIONS = f"""
arrays AS (
  SELECT k, list({_PLAIN_ITEM} ORDER BY lineNumber) AS plain,
    list({_CHANGED_ITEM} ORDER BY lineNumber) AS changed,
    sum(CAST(round(lineTotal * 100) AS BIGINT)) AS cents
  FROM fx_lines GROUP BY k),
invoices AS (
  SELECT h.*, a.plain, a.changed, a.cents FROM fx_header h LEFT JOIN arrays a ON h.k = a.k),
primary_raw AS (
  SELECT * REPLACE (
      CASE WHEN k % 6 = 0 THEN ' ' WHEN k % 6 = 1 THEN 'N/A' ELSE vendorName END AS vendorName,
      CASE WHEN k % 8 = 0 THEN NULL ELSE totalAmount END AS totalAmount,
      CASE WHEN k % 10 = 0 THEN '' ELSE shipping_address END AS shipping_address),
    invoiceDate AS raw_date,
    CASE WHEN k % 4 = 1 THEN 'from the first source' END AS summary,
    CASE WHEN k % 21 = 0 THEN '' ELSE 'OK' END AS flags,
    CAST(cents AS DOUBLE) / CAST(100 AS DOUBLE) + CAST(CASE WHEN k % 14 = 3 THEN 5 ELSE 0 END AS DOUBLE) AS subtotalAmount,
    CASE WHEN k % 9 = 0 THEN NULL ELSE changed END AS items,
    CASE WHEN k % 37 = 0 THEN [invoiceNumber, invoiceNumber] WHEN k % 5 = 1 THEN CAST([] AS VARCHAR[])
         ELSE [invoiceNumber] END AS barcodes
  FROM invoices WHERE k % 7 <> 0),
fallback_raw AS (
  SELECT * REPLACE (
      CASE WHEN k % 9 = 0 THEN 'na' ELSE branch END AS branch,
      CASE WHEN k % 12 = 0 THEN totalAmount + 1.0 ELSE totalAmount END AS totalAmount,
      CAST(0.0 AS DOUBLE) AS freightAmount,
      upper(shipping_state) AS shipping_state,
      CAST(15 AS INTEGER) AS termsNetDuedays),
    invoiceDate AS raw_date,
    CASE WHEN k % 2 = 1 THEN 'from the second source' END AS summary,
    'OK' AS flags,
    CAST(NULL AS DOUBLE) AS subtotalAmount,
    plain AS items,
    [invoiceNumber] AS barcodes
  FROM invoices WHERE k % 11 <> 0),
p AS ({flat_of('primary_raw')}),
f AS ({flat_of('fallback_raw')})
"""


def nz(c: str) -> str:
    return f"CASE WHEN lower(trim({c})) IN ('', 'n/a', 'na') THEN NULL ELSE {c} END"


BLANK_AWARE = (
    "invoiceNumber vendorName orderNumber purchaseOrderNumber bolNumber vendorNumber branch warehouse "
    "shipping_address shipping_city shipping_state shipping_zip "
    "remittance_address remittance_city remittance_state remittance_zip"
).split()
PRIMARY_FIRST = (
    "source_file_path source_file_name source_volume_path error flags invoiceDate discountDate discountAmount "
    "freightAmount subtotalAmount totalAmount termsDiscountPercentage termsDiscountDueDays termsNetDuedays"
).split()

MERGED = (
    "merged AS (SELECT coalesce(p.k, f.k) AS k, "
    + ", ".join(f"coalesce({nz('p.' + c)}, {nz('f.' + c)}) AS {c}" for c in BLANK_AWARE)
    + ", "
    + ", ".join(f"coalesce(p.{c}, f.{c}) AS {c}" for c in PRIMARY_FIRST)
    + """,
    coalesce(f.summary, p.summary) AS summary, coalesce(f.document_type, p.document_type) AS document_type,
    CASE WHEN len(p.items) > 0 THEN p.items WHEN len(f.items) > 0 THEN f.items END AS items,
    CASE WHEN len(p.barcodes) > 0 THEN p.barcodes WHEN len(f.barcodes) > 0 THEN f.barcodes END AS barcodes
  FROM p FULL JOIN f ON p.source_file_path IS NOT DISTINCT FROM f.source_file_path)
"""
)

REPORTED = (
    "source_file_path source_file_name source_volume_path error flags summary document_type invoiceNumber vendorName "
    "orderNumber purchaseOrderNumber bolNumber vendorNumber branch warehouse invoiceDate discountDate discountAmount "
    "freightAmount subtotalAmount totalAmount shipping_address shipping_city shipping_state shipping_zip "
    "remittance_address remittance_city remittance_state remittance_zip termsDiscountPercentage termsDiscountDueDays "
    "termsNetDuedays"
).split()
HEADER_OUT = (
    "invoiceNumber vendorName orderNumber purchaseOrderNumber vendorNumber branch warehouse totalAmount freightAmount "
    "shipping_address shipping_city shipping_state shipping_zip termsNetDuedays"
).split()

INVOICE = f"WITH {HEADERS}, {LINES}"
SOURCES = f"WITH {HEADERS}, {LINES}, {EXTRACTIONS}"
MERGE = f"{SOURCES}, {MERGED}"


def cols(names: list[str], prefix: str = "") -> str:
    return ", ".join(prefix + n for n in names)


# --- intake -------------------------------------------------------------------------

ORACLES["intake_incremental"] = f"""
WITH {FILES}, {PENDING}
SELECT path, length, modificationTime FROM pending
"""

ORACLES["intake_high_water"] = f"""
WITH {FILES}
SELECT 'all' AS slice, coalesce(max(ingestion_timestamp), TIMESTAMP '2025-09-01 00:00:00') AS high_water_mark FROM files
UNION ALL
SELECT 'empty', coalesce(max(ingestion_timestamp), TIMESTAMP '2025-09-01 00:00:00') FROM files WHERE doc_id < 0
"""

ORACLES["recent_intake_count"] = f"""
WITH {FILES}
SELECT 'ingested' AS kind, count(*) AS n_recent FROM files
WHERE ingestion_timestamp >= TIMESTAMP '2025-09-20 00:00:30' - INTERVAL '1' MINUTE
UNION ALL
SELECT 'modified', count(*) FROM files WHERE modificationTime >= TIMESTAMP '2025-09-20 00:00:00' - INTERVAL '12' DAY
"""

ORACLES["pending_dates"] = f"""
WITH {FILES}, {PENDING}
SELECT DISTINCT CAST(modificationTime AS DATE) AS process_date FROM pending
"""

ORACLES["pending_files_for_day"] = f"""
WITH {FILES}, {PENDING}
SELECT path, modificationTime FROM pending
WHERE CAST(modificationTime AS DATE) = DATE '2025-09-05'
"""

ORACLES["backfill_daily_counts"] = f"""
WITH {FILES}, {PENDING}
SELECT CAST(modificationTime AS DATE) AS process_date, count(*) AS n_files FROM pending GROUP BY 1
"""

ORACLES["extension_breakdown"] = f"""
WITH {FILES}
SELECT regexp_extract(path, '\\.([^.]+)$', 1) AS extension, count(*) AS n FROM files GROUP BY 1
"""

ORACLES["latest_files"] = f"""
WITH {FILES}
SELECT path, modificationTime, ingestion_timestamp FROM files ORDER BY modificationTime DESC, path LIMIT 5
"""

ORACLES["path_parts"] = f"""
WITH {FILES}
SELECT path, regexp_extract(path, '([^/]*)$', 1) AS file_name, regexp_extract(path, '^(.*/)[^/]+$', 1) AS dir FROM files
"""

# --- parsing ------------------------------------------------------------------------

_LINES_OF_TEXT = "list_filter(string_split_regex(text, '\\r?\\n'), lambda x: regexp_matches(x, '[^ \\t\\r\\n]'))"

ORACLES["route_by_extension"] = f"""
WITH {FILES}, staged AS (
  SELECT path, lower(regexp_extract(path, '(\\.[^.]+)$', 1)) IN ('.pdf', '.jpg', '.jpeg', '.png') AS parsed, text,
    {_LINES_OF_TEXT} AS lines FROM files)
SELECT path, CASE WHEN parsed THEN 'parsed' ELSE 'plain' END AS branch,
  CASE WHEN NOT parsed THEN length(text)
       WHEN len(lines) > 0 THEN length(array_to_string(lines, chr(10) || chr(10))) END AS n_chars
FROM staged
"""

ORACLES["decode_text"] = f"""
WITH {FILES}
SELECT path, length(text) AS n_chars, md5(text) AS text_md5 FROM files
"""

ORACLES["extract_text_function"] = f"""
WITH {FILES}
SELECT path, CASE WHEN length(text) >= 20 THEN md5(text) END AS text_md5,
  CASE WHEN length(text) < 20 THEN 'ValueError: too short' END AS text_error FROM files
"""

ORACLES["elements_exploded"] = f"""
WITH s AS (SELECT doc_id, {_LINES_OF_TEXT} AS lines FROM documents)
SELECT doc_id, unnest(range(len(lines))) AS idx, md5(unnest(lines)) AS content_md5 FROM s
"""

ORACLES["elements_to_text"] = f"""
SELECT doc_id, md5(array_to_string({_LINES_OF_TEXT}, chr(10) || chr(10))) AS text_md5 FROM documents
"""

_BLOCK = (
    "address|article|aside|blockquote|body|br|caption|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|"
    "h1|h2|h3|h4|h5|h6|head|header|hr|html|li|main|nav|ol|p|pre|section|table|tbody|tfoot|thead|title|tr|ul"
)
_NAMED = [
    ("&nbsp;", " "),
    ("&copy;", "©"),
    ("&reg;", "®"),
    ("&middot;", "·"),
    ("&ndash;", "–"),
    ("&mdash;", "—"),
    ("&hellip;", "…"),
    ("&euro;", "€"),
    ("&quot;", '"'),
    ("&apos;", "''"),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&amp;", "&"),
]


def _decoded(c: str) -> str:
    for name, value in _NAMED:
        c = f"replace({c}, '{name}', '{value}')"
    return c


_PAGE_ELEMENTS = f"""
pieces AS (
  SELECT page_id, string_split(regexp_replace(regexp_replace(replace(html, chr(30), ' '),
    '(?is)<!--.*?-->|<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>', ' ', 'g'),
    '(?i)(</?(?:{_BLOCK})\\b)', chr(30) || '\\1', 'g'), chr(30)) AS ps FROM pages),
each_piece AS (SELECT page_id, unnest(range(len(ps))) AS pos, unnest(ps) AS piece FROM pieces),
found AS (
  SELECT page_id, pos, lower(regexp_extract(piece, '^<([a-zA-Z][a-zA-Z0-9]*)', 1)) AS tag,
    trim(regexp_replace({_decoded("regexp_replace(piece, '(?s)<[^>]*>', '', 'g')")}, '\\s+', ' ', 'g')) AS content
  FROM each_piece),
elements AS (
  SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1 AS idx,
    CASE WHEN tag = '' THEN 'text' ELSE tag END AS tag, content
  FROM found WHERE content <> '')
"""

ORACLES["html_elements"] = f"WITH {_PAGE_ELEMENTS} SELECT page_id, idx, tag, content FROM elements"

ORACLES["html_markdown"] = f"""
WITH {_PAGE_ELEMENTS}
SELECT page_id, md5(string_agg(' ' || content, '' ORDER BY idx)) AS text_md5 FROM elements GROUP BY page_id
"""

# --- enrichment ---------------------------------------------------------------------

# The labelled lines of a text invoice; items hold none of the counted phrases.
_TEXTS = """
texts AS (
  SELECT concat('doc-', CAST(doc_id AS VARCHAR)) AS id, text FROM documents
  UNION ALL
  SELECT source_file_path, concat_ws(chr(10), 'Invoice',
    'Invoice Number: ' || invoiceNumber, 'Vendor Name: ' || vendorName, 'Order Number: ' || orderNumber,
    'Purchase Order Number: ' || purchaseOrderNumber, 'Vendor Number: ' || vendorNumber, 'Branch: ' || branch,
    'Warehouse: ' || warehouse, 'Invoice Date: ' || invoiceDate, 'Freight Amount: 0', 'Total Amount: 0',
    'Terms Net Due Days: ' || termsNetDuedays, 'Ship To Address: ' || shipping_address,
    'Ship To City: ' || shipping_city, 'Ship To State: ' || shipping_state, 'Ship To Zip: ' || shipping_zip,
    'Flags: OK', 'Barcode: ' || invoiceNumber)
  FROM fx_header)
"""


def _count_of(phrases: str) -> str:
    return f"len(regexp_extract_all(lower(text), '{phrases}'))"


_LABELLED = f"""
counts AS (
  SELECT *, {_count_of('invoice|bill to|amount due|remit to')} AS a,
    {_count_of('receipt|amount paid|change due|thank you for your purchase')} AS b,
    {_count_of('purchase order|requested by|delivery date')} AS c,
    {_count_of('contract|agreement|hereby|licens|the parties')} AS d
  FROM texts),
labelled AS (
  SELECT id, CASE WHEN coalesce(length(text), 0) = 0 THEN 'unknown' WHEN greatest(a, b, c, d) = 0 THEN 'other'
    WHEN a = greatest(a, b, c, d) THEN 'invoice' WHEN b = greatest(a, b, c, d) THEN 'receipt'
    WHEN c = greatest(a, b, c, d) THEN 'purchase_order' ELSE 'contract' END AS document_type
  FROM counts)
"""

ORACLES["classify_documents"] = f"WITH {HEADERS}, {_TEXTS}, {_LABELLED} SELECT id, document_type FROM labelled"

ORACLES["type_breakdown"] = f"""
WITH {HEADERS}, {_TEXTS}, {_LABELLED}
SELECT document_type, count(*) AS n FROM labelled GROUP BY document_type
"""

ORACLES["route_by_type"] = f"""
WITH {HEADERS}, {_TEXTS}, {_LABELLED}
SELECT 'main' AS destination, count(*) AS n FROM labelled WHERE document_type = 'invoice'
UNION ALL SELECT 'other', count(*) FROM labelled WHERE document_type IS DISTINCT FROM 'invoice'
"""

ORACLES["lead_summary"] = """
SELECT doc_id, CASE WHEN length(text) > 0 THEN
    trim(regexp_replace(array_to_string(
      string_split(regexp_replace(text, '([.!?]+)\\s+', '\\1' || chr(30), 'g'), chr(30))[1:3], ' '),
      '\\s+', ' ', 'g'))
  ELSE 'No summary available' END AS summary
FROM documents
"""

ORACLES["enrich_second_source"] = f"""
WITH {FILES}, {PENDING},
texts AS (SELECT path AS id, text FROM files WHERE path LIKE '%.pdf'), {_LABELLED}
SELECT p.path, l.document_type FROM pending p LEFT JOIN labelled l ON l.id = p.path
"""

_IS_PARSED = "regexp_matches(lower(path), '\\.(pdf|jpg|jpeg|png)$')"

ORACLES["rejected_documents"] = f"""
WITH {FILES}
SELECT path, CASE WHEN doc_id % 10 = 7 AND {_IS_PARSED} THEN 'not text'
  WHEN {_IS_PARSED} AND NOT regexp_matches(text, '[^ \t\r\n]') THEN 'no elements' END AS reason
FROM files
"""

ORACLES["parse_with_function"] = f"""
WITH {FILES},
read AS (SELECT path, {_IS_PARSED} AS parsed, strlen(text) % 7 = 0 AS bad, text FROM files)
SELECT path, CASE WHEN parsed AND bad THEN 'ValueError: odd size' END AS reason,
  CASE WHEN NOT parsed THEN md5(text) WHEN NOT bad THEN md5(replace(text, chr(10), '|')) END AS text_md5
FROM read
"""

ORACLES["second_source_errors"] = f"""
WITH {FILES}, {PENDING}
SELECT path, CASE WHEN strlen(text) % 5 = 0 THEN 'ValueError: unreadable' END AS error,
  CASE WHEN strlen(text) % 5 <> 0 THEN md5(text) END AS text_md5
FROM pending
"""

# Documents as the flow routes them; the type is that of the text, as in classify_documents.
_ROUTED = f"""
WITH {FILES}, lined AS (
  SELECT path, modificationTime, {_IS_PARSED} AS parsed, text AS plain, {_LINES_OF_TEXT} AS lines FROM files),
texts AS (SELECT path AS id, path, modificationTime, CASE WHEN NOT parsed THEN plain
    WHEN len(lines) > 0 THEN array_to_string(lines, chr(10) || chr(10)) END AS text FROM lined), {_LABELLED},
routed AS (SELECT texts.*, document_type, CAST(modificationTime AS DATE) AS process_date, CASE WHEN text IS NULL THEN 'rejected'
    WHEN document_type = 'contract' THEN 'main' ELSE 'other' END AS destination FROM texts JOIN labelled USING (id))
"""

ORACLES["backfill_restart"] = f"""
{_ROUTED} SELECT destination, process_date, count(*) AS n_files, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM routed GROUP BY ALL
"""

ORACLES["listed_intake"] = ORACLES["file_intake"] = f"""
WITH {FILES} SELECT path, strlen(text) AS length, md5(text) AS content_md5 FROM files
"""

ORACLES["second_source_replaced"] = f"""
{_ROUTED}
SELECT path, document_type, process_date, md5(CASE WHEN process_date = DATE '2025-09-05' THEN upper(plain)
  WHEN process_date = (SELECT min(process_date) FROM routed WHERE destination = 'main') THEN 'lost' ELSE 'first reading' END) AS text_md5
FROM routed JOIN lined USING (path) WHERE destination = 'main'
"""

# --- extraction ---------------------------------------------------------------------

_LINE_COLUMNS = "lineNumber, productCode, uom, quantityShipped, weightShipped, unitPrice, lineTotal"
_WITH_PATH = "FROM fx_lines l JOIN fx_header h ON l.k = h.k"

ORACLES["extract_header"] = f"""
{INVOICE} SELECT source_file_path, {cols(HEADER_OUT)}, invoiceDate, 'OK' AS flags FROM fx_header
"""

ORACLES["extract_lines"] = f"{INVOICE} SELECT h.source_file_path, {_LINE_COLUMNS} {_WITH_PATH}"

ORACLES["inference_errors"] = f"WITH {HEADERS} SELECT source_file_path, k % 19 = 0 AS has_error FROM fx_header"

ORACLES["inference_function_errors"] = ORACLES["stream_inference"] = f"""
WITH {HEADERS}
SELECT source_file_path, k % 19 = 0 AS has_error, CASE WHEN k % 19 <> 0 THEN invoiceNumber END AS invoiceNumber
FROM fx_header
"""

ORACLES["canonical_gate"] = f"""
WITH {HEADERS} SELECT source_file_path FROM fx_header WHERE k % 19 <> 0 AND k % 23 <> 0
"""

ORACLES["payload_header"] = ORACLES["stream_canonical"] = f"""
{INVOICE}, raw AS (
  SELECT h.*, invoiceDate AS raw_date, 'OK' AS flags, CAST(NULL AS VARCHAR) AS summary,
    CAST(NULL AS DOUBLE) AS subtotalAmount, CAST(NULL AS VARCHAR[]) AS barcodes, a.items
  FROM fx_header h LEFT JOIN (SELECT k, list(lineNumber) AS items FROM fx_lines GROUP BY k) a
    ON h.k = a.k
  WHERE h.k % 19 <> 0 AND h.k % 23 <> 0),
flat AS ({flat_of('raw')})
SELECT {cols(REPORTED)}, line_items_count FROM flat
"""

ORACLES["payload_lines"] = f"""
{INVOICE} SELECT h.source_file_path, {_LINE_COLUMNS} {_WITH_PATH} WHERE h.k % 19 <> 0 AND h.k % 23 <> 0
"""

ORACLES["payload_barcodes"] = f"""
WITH {HEADERS}
SELECT source_file_path, invoiceNumber AS barcode FROM fx_header WHERE k % 19 <> 0 AND k % 23 <> 0
"""

_LINES_OF_PAYLOADS = f"""
WITH {HEADERS}, {LINES},
l AS (SELECT source_file_path, l.k, row_number() OVER (PARTITION BY l.k ORDER BY lineNumber) - 1 AS i, lineNumber, productCode, unitPrice
      FROM fx_lines l JOIN fx_header h ON l.k = h.k WHERE l.k % 19 <> 0)
"""

ORACLES["payload_missing_keys"] = f"""
{_LINES_OF_PAYLOADS}
SELECT source_file_path, 'key_present' AS rule, 'branch' AS field, CAST(NULL AS VARCHAR) AS value
FROM fx_header WHERE k % 19 <> 0 AND k % 4 = 1
UNION ALL SELECT source_file_path, 'key_present', 'lineItems[' || i || '].unitPrice', NULL FROM l WHERE k % 5 = 2
"""

ORACLES["violations_cast"] = f"""
{_LINES_OF_PAYLOADS}
SELECT source_file_path, 'kind' AS rule, 'lineItems[' || i || '].lineNumber' AS field, '"one"' AS value
FROM l WHERE k % 6 = 3 AND lineNumber = 1
"""

ORACLES["damaged_lines"] = f"""
{_LINES_OF_PAYLOADS}
SELECT source_file_path, i AS idx, CASE WHEN k % 6 = 3 AND lineNumber = 1 THEN NULL ELSE lineNumber END AS lineNumber, productCode,
       CASE WHEN k % 5 <> 2 THEN unitPrice END AS unitPrice
FROM l WHERE k % 23 <> 0
"""

# --- records ------------------------------------------------------------------------

ORACLES["flatten_header"] = ORACLES["renest_single"] = f"""
{SOURCES} SELECT {cols(REPORTED)}, line_items_count FROM p
"""
# Nesting again makes a struct of blank parts only if one part is not NULL; the flat result is the same.

ORACLES["normalize_dates"] = f"""
WITH {HEADERS}
SELECT source_file_path, invoiceDate AS raw, {strict_date('invoiceDate')} AS strict,
  CASE WHEN k % 4 IN (1, 2) THEN CAST(try_strptime(invoiceDate, '%m/%d/%Y') AS DATE) END AS lenient
FROM fx_header
"""

ORACLES["line_items_count"] = f"{SOURCES} SELECT source_file_path, line_items_count FROM p"

ORACLES["nz_cleanup"] = f"""
{SOURCES}
SELECT 'primary' AS side, k, {nz('vendorName')} AS a, {nz('shipping_address')} AS b FROM p
UNION ALL SELECT 'fallback', k, {nz('branch')}, {nz('shipping_address')} FROM f
"""

ORACLES["merge_sources"] = f"""
{MERGE}
SELECT source_file_path, source_file_name, summary, document_type, flags, {cols(HEADER_OUT)},
  strftime(invoiceDate, '%Y-%m-%d') AS invoiceDate, subtotalAmount FROM merged
"""

ORACLES["merge_nested"] = f"""
{MERGE}
SELECT source_file_path,
  coalesce(shipping_address, shipping_city, shipping_state, shipping_zip) IS NULL AS no_shipping,
  true AS no_remittance, termsNetDuedays IS NULL AS no_terms,
  shipping_address AS address, shipping_state AS state, termsNetDuedays AS net_days
FROM merged
"""

ORACLES["merge_arrays"] = f"""
{MERGE}
SELECT source_file_path, CAST(len(barcodes) AS INTEGER) AS n_barcodes, i.lineNumber, i.productCode, i.uom,
  i.quantityShipped, i.weightShipped, i.unitPrice, i.lineTotal
FROM (SELECT source_file_path, barcodes, unnest(CASE WHEN len(items) > 0 THEN items ELSE [NULL] END) AS i FROM merged)
"""

ORACLES["final_records"] = f"""
{MERGE} SELECT {cols(REPORTED)}, CAST(coalesce(len(items), 0) AS INTEGER) AS line_items_count FROM merged
"""

ORACLES["emit_json"] = f"""
{MERGE}
SELECT source_file_path, {cols(HEADER_OUT)}, invoiceDate,
  CAST(coalesce(len(items), 0) AS INTEGER) AS line_items_count FROM merged
"""

# --- quality ------------------------------------------------------------------------

TEXT, NUMBER, WHOLE, DAY = "''", "0.0", "0", "DATE '1900-01-01'"
COMPARED = {
    "input": TEXT,
    "source_file_path": TEXT,
    "source_volume_path": TEXT,
    "error": TEXT,
    "summary": TEXT,
    "document_type": TEXT,
    "orderNumber": TEXT,
    "bolNumber": TEXT,
    "vendorNumber": TEXT,
    "vendorName": TEXT,
    "invoiceNumber": TEXT,
    "invoiceDate": DAY,
    "purchaseOrderNumber": TEXT,
    "branch": TEXT,
    "warehouse": TEXT,
    "discountAmount": NUMBER,
    "discountDate": DAY,
    "freightAmount": NUMBER,
    "totalAmount": NUMBER,
    "subtotalAmount": NUMBER,
    "shipping_address": TEXT,
    "shipping_city": TEXT,
    "shipping_state": TEXT,
    "shipping_zip": TEXT,
    "remittance_address": TEXT,
    "remittance_city": TEXT,
    "remittance_state": TEXT,
    "remittance_zip": TEXT,
    "termsDiscountPercentage": NUMBER,
    "termsDiscountDueDays": WHOLE,
    "termsNetDuedays": WHOLE,
    "flags": TEXT,
    "barcodes": None,
    "line_items_json": TEXT,
    "line_items_count": WHOLE,
}
DOTTED = ("input", "summary", "barcodes", "line_items_json")


def _status(name: str, default: str | None) -> str:
    if default is None:
        differs = f"p.{name} IS DISTINCT FROM f.{name}"
    else:
        differs = f"coalesce(p.{name}, {default}) <> coalesce(f.{name}, {default})"
    return f"CASE WHEN {differs} THEN 'DIFF' ELSE 'SAME' END AS {name}_status"


def _preview(name: str, default: str | None) -> str:
    def side(s: str) -> str:
        c = f"CAST({s}_{name} AS VARCHAR)"
        return f"coalesce({c}, 'NULL')"

    quoted = default in (TEXT, DAY, None)
    opening = '"' if quoted else ""
    closing = '..."' if name in DOTTED else opening
    text = f"concat('OCR: {opening}', {side('p')}, '{closing} | AI: {opening}', {side('f')}, '{closing}')"
    return f"CASE WHEN {name}_status = 'DIFF' THEN {text} END AS {name}_diff"


STATUSES = (
    "statuses AS (SELECT coalesce(p.source_file_path, f.source_file_path) AS key,"
    " coalesce(p.source_file_name, f.source_file_name) AS file_name,"
    " p.k IS NOT NULL AS in_p, f.k IS NOT NULL AS in_f, "
    + ", ".join(_status(n, d) for n, d in COMPARED.items())
    + ", "
    + ", ".join(f"p.{n} AS p_{n}, f.{n} AS f_{n}" for n in COMPARED)
    + " FROM p FULL JOIN f ON p.source_file_path = f.source_file_path)"
)

ORACLES["field_status"] = f"""
{SOURCES}, {STATUSES}
SELECT key AS source_file_path, {", ".join(f"{n}_status" for n in COMPARED)} FROM statuses
"""

_TOTAL = " + ".join(f"CAST({n}_status = 'DIFF' AS INTEGER)" for n in COMPARED)
_NAMES = ", ".join(f"CASE WHEN {n}_status = 'DIFF' THEN '{n}' END" for n in COMPARED)
ORACLES["field_diff_report"] = f"""
{SOURCES}, {STATUSES}
SELECT file_name, key,
  CASE WHEN in_p AND in_f THEN 'BOTH' WHEN in_p THEN 'OCR_ONLY' ELSE 'AI_ONLY' END AS coverage,
  {_TOTAL} AS total_differences, concat_ws(', ', {_NAMES}) AS different_columns,
  {", ".join(_preview(n, d) for n, d in COMPARED.items() if n != "source_volume_path")}
FROM statuses WHERE {_TOTAL} > 0
"""

ORACLES["field_diff_summary"] = f"""
{SOURCES}, {STATUSES}
SELECT field, status, count(*) AS n FROM (
  {" UNION ALL ".join(f"SELECT '{n}' AS field, {n}_status AS status FROM statuses" for n in COMPARED)})
GROUP BY field, status
"""

ORACLES["record_counts"] = f"""
{MERGE}, {FILES}
SELECT 'documents' AS source_table, count(*) AS record_count FROM files
UNION ALL SELECT 'processed', count(*) FROM ledger
UNION ALL SELECT 'primary', count(*) FROM p
UNION ALL SELECT 'fallback', count(*) FROM f
UNION ALL SELECT 'final', count(*) FROM merged
"""

_SIDES = """
sides AS (
  SELECT coalesce(f.source_file_path, p.source_file_path) AS file_name,
    CASE WHEN f.k IS NOT NULL AND p.k IS NOT NULL THEN 'BOTH' WHEN f.k IS NOT NULL THEN 'AI_ONLY'
         ELSE 'OCR_ONLY' END AS processing_status
  FROM f FULL JOIN p ON f.source_file_path = p.source_file_path)
"""

ORACLES["coverage_status"] = f"""
{SOURCES}, {_SIDES} SELECT processing_status, count(*) AS file_count FROM sides GROUP BY processing_status
"""

ORACLES["missing_files_sample"] = f"""
{SOURCES}, {_SIDES}
SELECT processing_status, file_name FROM sides WHERE processing_status <> 'BOTH'
ORDER BY processing_status, file_name LIMIT 20
"""

ORACLES["merge_pairs_count"] = f"""
{SOURCES}
SELECT p.k IS NOT NULL AS in_left, f.k IS NOT NULL AS in_right, count(*) AS n
FROM p FULL JOIN f ON p.source_file_path = f.source_file_path GROUP BY 1, 2
"""

# --- rules --------------------------------------------------------------------------


def _rule(rule: str, field: str, value: str, condition: str, source: str = "p") -> str:
    return (
        f"SELECT source_file_path, '{rule}' AS rule, {field} AS field, CAST({value} AS VARCHAR) AS value"
        f" FROM {source} WHERE {condition}"
    )


def _union(*parts: str) -> str:
    return " UNION ALL ".join(parts)


_EACH_LINE = "each_line AS (SELECT source_file_path, unnest(items) AS i FROM p WHERE items IS NOT NULL)"
_NOT_NULL = {
    "orderNumber": "orderNumber",
    "vendorName": "vendorName",
    "invoiceNumber": "invoiceNumber",
    "invoiceDate": "raw_date",
    "purchaseOrderNumber": "purchaseOrderNumber",
    "branch": "branch",
    "warehouse": "warehouse",
    "discountAmount": "discountAmount",
    "freightAmount": "freightAmount",
    "totalAmount": "totalAmount",
    "subtotalAmount": "subtotalAmount",
    "remittanceAddress": "remittance_address",
    "shippingAddress.address": "shipping_address",
    "shippingAddress.city": "shipping_city",
    "shippingAddress.state": "shipping_state",
    "shippingAddress.zip": "shipping_zip",
    "paymentTerms.termsNetDuedays": "termsNetDuedays",
}
_HAS_TEXT = {
    "orderNumber": "orderNumber",
    "vendorName": "vendorName",
    "invoiceNumber": "invoiceNumber",
    "purchaseOrderNumber": "purchaseOrderNumber",
    "shippingAddress.address": "shipping_address",
    "shippingAddress.city": "shipping_city",
    "flags": "flags",
}
_RULES = {
    "required": _union(
        *[_rule("required", f"'{f}'", "NULL", f"{c} IS NULL") for f, c in _NOT_NULL.items()],
        *[_rule("not_blank", f"'{f}'", c, f"trim({c}) = ''") for f, c in _HAS_TEXT.items()],
    ),
    "pattern": _union(
        *[
            _rule("pattern", f"'{f}'", c, f"NOT regexp_matches({c}, '{p}')")
            for f, c, p in (
                ("branch", "branch", "^[0-9]{3}$"),
                ("warehouse", "warehouse", "^[0-9]{3}$"),
                ("shippingAddress.state", "shipping_state", "^[A-Z]{2}$"),
                ("shippingAddress.zip", "shipping_zip", "^[0-9]{5}(-[0-9]{4})?$"),
            )
        ],
        _rule(
            "iso_date",
            "'invoiceDate'",
            "raw_date",
            "NOT regexp_matches(raw_date, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$') OR try_strptime(raw_date, '%Y-%m-%d') IS NULL",
        ),
    ),
    "negative": _union(
        *[
            _rule("not_negative", f"'{f}'", f, f"{f} < 0")
            for f in ("freightAmount", "subtotalAmount", "totalAmount", "discountAmount")
        ],
        *[
            _rule("not_negative", f"concat('lineItems[', i.lineNumber, '].{f}')", f"i.{f}", f"i.{f} < 0", "each_line")
            for f in ("quantityShipped", "weightShipped", "unitPrice", "lineTotal")
        ],
    ),
    "line_seq": _rule(
        "line_sequence",
        "'lineItems.lineNumber'",
        "array_to_string(list_transform(items, lambda x: x.lineNumber), ',')",
        "len(items) > 0 AND list_transform(items, lambda x: x.lineNumber) <> list_transform(range(1, len(items) + 1), lambda x: CAST(x AS INTEGER))",
    ),
    "line_total": _rule(
        "line_total",
        "concat('lineItems[', i.lineNumber, '].lineTotal')",
        "i.lineTotal",
        "abs(i.lineTotal - i.quantityShipped * i.unitPrice) > 0.01",
        "each_line",
    ),
    "subtotal": _rule(
        "subtotal",
        "'subtotalAmount'",
        "subtotalAmount",
        "items IS NOT NULL AND abs(subtotalAmount - list_sum(list_transform(items, lambda x: x.lineTotal))) > 0.01",
    ),
    "cardinality": _union(
        _rule("min_items", "'lineItems'", "0", "line_items_count = 0"),
        _rule("unique", "'barcodes'", "array_to_string(barcodes, ',')", "len(list_distinct(barcodes)) <> len(barcodes)"),
    ),
}
for _name, _sql in _RULES.items():
    ORACLES[f"violations_{_name}"] = f"{SOURCES}, {_EACH_LINE} {_sql}"

ORACLES["violation_summary"] = f"""
{SOURCES}, {_EACH_LINE}, broken AS ({_union(*[f"SELECT * FROM ({s})" for s in _RULES.values()])})
SELECT rule, regexp_replace(field, '\\[[^\\]]*\\]', '', 'g') AS field, count(*) AS n FROM broken GROUP BY 1, 2
"""

ORACLES["stream_twice"] = ORACLES["stream_canonical"]

ORACLES["stream_rewritten"] = f"""
WITH {FILES}, seen AS (SELECT path, md5(text) AS text_md5, doc_id % 3 <> 0 AS early, doc_id % 5 = 0 AS changed FROM files)
SELECT path, text_md5, CASE WHEN changed AND NOT early THEN 'second' ELSE 'first' END AS label, CAST(1 AS INTEGER) AS emission FROM seen
UNION ALL SELECT path, text_md5, 'second', CAST(2 AS INTEGER) FROM seen WHERE changed AND early
"""

ORACLES["stream_merge"] = f"""
{SOURCES}
SELECT coalesce(p.source_file_path, f.source_file_path) AS key, p.k IS NOT NULL AS in_left, f.k IS NOT NULL AS in_right,
  coalesce(f.summary, p.summary) AS summary, coalesce({nz('p.vendorName')}, {nz('f.vendorName')}) AS vendorName,
  coalesce({nz('p.branch')}, {nz('f.branch')}) AS branch, coalesce(p.totalAmount, f.totalAmount) AS totalAmount,
  coalesce(p.freightAmount, f.freightAmount) AS freightAmount, coalesce(p.invoiceDate, f.invoiceDate) AS invoiceDate,
  coalesce({nz('p.shipping_state')}, {nz('f.shipping_state')}) AS shipping_state, coalesce(p.termsNetDuedays, f.termsNetDuedays) AS termsNetDuedays
FROM p FULL JOIN f ON p.source_file_path = f.source_file_path
"""

ORACLES["views_kept"] = ORACLES["final_records"]

ORACLES["pending_in_place"] = f"""
WITH {FILES}, {PENDING} SELECT path, CAST(modificationTime AS DATE) AS process_date, md5(text) AS content_md5 FROM pending
"""

ORACLES["backfill_in_place"] = ORACLES["backfill_restart"]

_CROWDED = """
WITH crowded AS (SELECT CAST(CASE WHEN (l_orderkey + l_linenumber) % 3 = 0 THEN 0 ELSE l_orderkey END AS BIGINT) AS k, CAST(l_orderkey AS BIGINT) AS first_order,
    CAST(l_linenumber AS INTEGER) AS lineNumber, CAST(l_partkey AS BIGINT) AS part, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
    l_quantity AS q, l_extendedprice / l_quantity AS price, l_extendedprice + CASE WHEN l_partkey % 11 = 0 THEN 1.0 ELSE 0.0 END AS total FROM lineitem),
placed AS (SELECT *, row_number() OVER w AS position, CAST(sum(cents) OVER w AS BIGINT) AS running_cents, CAST(sum(lineNumber) OVER w AS BIGINT) AS running_lines
  FROM crowded WINDOW w AS (PARTITION BY k ORDER BY first_order, lineNumber, part, cents ROWS UNBOUNDED PRECEDING))
"""

ORACLES["lines_numbered"] = f"{_CROWDED} SELECT k, first_order, lineNumber, part, cents, position, running_cents, running_lines FROM placed"

ORACLES["violations_of_lines"] = f"""
{_CROWDED}
SELECT k AS source_file_path, 'line_sequence' AS rule, count(*) AS n FROM placed WHERE lineNumber <> position GROUP BY k
UNION ALL SELECT k, 'line_total', count(*) FROM placed WHERE abs(total - q * price) > 0.01 GROUP BY k
UNION ALL SELECT CAST(o_orderkey AS BIGINT), 'subtotal', 1 FROM orders LEFT JOIN (SELECT k, sum(total) AS s FROM placed GROUP BY k) ON k = o_orderkey
  WHERE abs(100.0 - coalesce(s, 0)) > 0.01
"""

ORACLES["line_changes"] = f"""
{INVOICE}, base AS (
  SELECT h.source_file_path AS key, l.k, lineNumber AS n, l.k % 7 <> 0 AND l.k % 9 <> 0 AS in_p, l.k % 11 <> 0 AS in_f, right(productCode, 1) = '3' AS gone
  FROM fx_lines l JOIN fx_header h ON l.k = h.k),
placed AS (SELECT *, CAST(sum(CASE WHEN gone THEN 0 ELSE 1 END) OVER (PARTITION BY k ORDER BY n) - 1 AS INTEGER) AS p_position, CAST(n - 1 AS INTEGER) AS f_position FROM base)
SELECT key, 'added' AS status, NULL AS p_position, f_position, NULL AS fields FROM placed WHERE in_f AND (gone OR NOT in_p)
UNION ALL SELECT key, 'removed', p_position, NULL, NULL FROM placed WHERE in_p AND NOT in_f AND NOT gone
UNION ALL SELECT key, 'changed', p_position, f_position, concat_ws(',', CASE WHEN k % 31 = 0 THEN 'lineNumber' END, CASE WHEN (k + n) % 29 = 0 THEN 'lineTotal' END)
  FROM placed WHERE in_p AND in_f AND NOT gone AND (k % 31 = 0 OR (k + n) % 29 = 0)
"""
