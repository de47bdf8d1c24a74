"""Domain-shaped inputs derived from the given tables.

The given tables hold no price lists, so each stand-in is a SELECT over a whole table written in
the SQL subset that Spark and the checking engine share. ``{table}`` marks the source table.
"""

from __future__ import annotations

from collections.abc import Sequence

from catalign.tables import TABLES


def quote(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, (int, float)):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def pick(selector: str, values: Sequence[object]) -> str:
    """``CASE selector % n`` over a list of literals."""
    arms = " ".join(f"WHEN {i} THEN {quote(v)}" for i, v in enumerate(values))
    return f"CASE CAST({selector} AS BIGINT) % {len(values)} {arms} END"


def plain(sql: str) -> str:
    """The same SELECT with bare table names, for the SQL twins."""
    return sql.format(**{name: name for name in TABLES})


CODES = ["LTTA", "MVTL850", "RENE900ACE", "SUMMIT850XLT", "FREE", "GTRS900", "EXPE", "ADVX600",
         "COMM", "RAVE850", "XTRA", "AB", "MXZ850ETECTURBO", "COBRA600RFOX", "UNKNOWN1", "TEST99",
         "RENEGADE900ACETURBO", "ASSAULT850MTN", "SWITCHBACK_SPORT_HEATED_SEAT",
         "POWERCLAW1000TOURING", "RIPSAW600TRAIL", "WALKER_EVANS_LIMITED", "AIR_RIDE_STORAGE",
         "WINDSHIELDREV", "RENX", "SUMM850", "BACK600EFI"]
BRANDS = ["Ski-Doo", "Lynx", "Polaris", "Arctic Cat", "Yamaha", "Ski-Doo", "Lynx"]
FAMILIES = ["MXZ_TRAIL", "MXZ_CROSSOVER", "RENEGADE", "SUMMIT", "FREERIDE", "GRAND_TOURING",
            "UTILITY", "ADVENTURE", "COMMANDER", "RAVE", "XTRIM", "ASSAULT", "SWITCHBACK"]

ENTRIES = f"""
SELECT p_partkey AS entry_id,
       {pick('p_partkey', CODES)} AS model_code,
       {pick('p_size', BRANDS)} AS brand,
       p_name AS model_name,
       CAST(5000 + (p_partkey * 37) % 21000 AS DOUBLE) AS price,
       {pick('p_partkey', ['EUR', 'EUR', 'EUR', 'RUB'])} AS currency,
       'FI' AS market,
       CAST(2019 + p_size % 7 AS INT) AS model_year,
       CAST(1 + p_size AS INT) AS page_number,
       CAST((p_partkey % 101) AS DOUBLE) / 100 AS extraction_confidence
FROM {{part}}"""

BASE_MODELS = f"""
SELECT family || suffix AS base_model_id,
       REPLACE(family, '_', ' ') || name_tail AS model_name,
       brand, model_year,
       {pick('variant_no', ['trail', 'mountain', 'utility'])} AS category,
       {pick('variant_no', ['600cc', '850cc', '900cc'])} AS displacement,
       {pick('variant_no', ['2-stroke', '2-stroke', '4-stroke'])} AS engine_type,
       {pick('variant_no', ['air ride', None, 'tMotion'])} AS suspension,
       {pick('family_no', ['sport', 'trail', 'mountain', None])} AS track_type,
       {pick('family_no + variant_no', [None, 'gps', 'bluetooth'])} AS connectivity,
       CAST(family_no * 1000 + brand_no * 100 + variant_no * 10 + model_year AS BIGINT) AS position
FROM (
  SELECT family_no, brand_no, variant_no, model_year,
         {pick('family_no', FAMILIES)} AS family, {pick('brand_no', BRANDS)} AS brand,
         {pick('variant_no', ['', '_X', '_LT'])} AS suffix,
         {pick('variant_no', ['', ' X-RS', ' Limited'])} AS name_tail
  FROM (SELECT DISTINCT p_partkey % 13 AS family_no, p_size % 5 AS brand_no,
               p_partkey % 3 AS variant_no, CAST(2019 + p_size % 7 AS INT) AS model_year
        FROM {{part}}) k
) f"""

MODELS = ["Summit X", "Ranger", "MXZ X-RS", "Renegade Adrenaline", "Expedition SE", "Rave RE",
          "Adventure LX", "Freeride", "Lynx Commander", None, "Q", "Catalyst", "Backcountry XRS"]
PACKAGES = ["Expert Package", "RE", None, "Standard", "Competition Package with WIS", "X"]
ENGINES = ["850 E-TEC Turbo R", "600R E-TEC", "900 ACE", "998cc Turbo", None, "600 EFI",
           "850 E-TEC", "900 ACE Turbo R"]
TRACKS = ["154in 3900mm 3.0in 76mm Powdermax X-light", "137in 3500mm 1.5in 38mm Ice Ripper XT",
          "129in 3300mm 1.6in 41mm Cobra", None, "146in 3700mm 2.5in 64mm PowderMax"]

PRODUCTS = f"""
SELECT o_orderkey AS product_id,
       {pick('o_orderkey', ['TJTH', 'FVTA', 'S1BX', 'LTTA', 'AB', 'TOOLONG', 'AYTS', 'VBTA', 'vbta'])} AS model_code,
       {pick('o_custkey', ['SKI-DOO', 'LYNX', 'BRP', 'POLARIS', '', 'SKI-DOO', 'LYNX'])} AS brand,
       CAST({pick('o_orderkey', [2023, 2024, 2025, 2026, 2014, 2031, 2022])} AS INT) AS model_year,
       {pick('o_orderkey', MODELS)} AS malli,
       {pick('o_custkey', PACKAGES)} AS paketti,
       {pick('o_orderkey', ENGINES)} AS moottori,
       {pick('o_custkey', TRACKS)} AS telamatto,
       {pick('o_orderkey', ['Electric', 'SHOT', None, 'Manual'])} AS kaynnistin,
       {pick('o_custkey', ['10.25 in. Color Touchscreen Display', '4.5 in. Digital Display', None])} AS mittaristo,
       {pick('o_custkey', ['Scandi Blue', 'Black', None, 'Terra Green'])} AS vari,
       CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 19 = 0 THEN -1.0
            WHEN o_orderkey % 23 = 0 THEN 12000000.5 ELSE o_totalprice END AS price,
       {pick('o_orderkey', ['EUR', 'RUB', 'EUR', 'USD', 'RUB'])} AS currency,
       {pick('o_custkey', ['FINLAND', 'RUSSIA', 'finland', 'NORWAY', None])} AS market
FROM {{orders}}"""

CATALOG = f"""
SELECT p_partkey AS position,
       {pick('p_partkey', ['Summit X', 'Ranger', 'MXZ', 'Renegade', 'Expedition SE', 'Rave', 'Adventure', 'Freeride', 'Commander', 'Tundra LE', 'Backcountry'])}
         || ' ' || p_name AS model_family,
       {pick('p_size', ['SKI-DOO', 'LYNX', 'BRP SKI-DOO', '', 'YAMAHA'])} AS brand,
       {pick('p_partkey', ['850 E-TEC Turbo R', '600R E-TEC', '900 ACE', '600 EFI'])} AS engine,
       p_type || ' platform' AS feature
FROM {{part}}"""

LINES = ["S U M M I T   X", "what''s new".replace("''", "'"), "PACKAGE HIGHLIGHTS", "FEATURES",
         "• New bodywork", "• Wide LED headlight", "• new bodywork",
         "overall length 3040 mm", "overall width 1100 mm", "ski stance 1097 mm",
         "dry weight 240 kg", "850 E-TEC TURBO R", "PowderMax 154 x 16 x 3.0",
         "liquid-cooled two-stroke", "82.0 x 80.4 mm", "displacement 800 - 849.7 cc",
         "fuel system E-TEC direct injection", "premium unleaded", "fuel tank 36 L",
         "R A V E   R E   W I T H   E N D U R O   P A C K A G E", "900 ACE TURBO", "600R E-TEC",
         "Cobra 137 x 15 x 1.6", "dry weight 219 kg", "Rotax cylinders", "M X Z   S P O R T",
         "E X P E D I T I O N   S E", "A D V E N T U R E   L X", "F R E E R I D E"]

# The markup of a real page, tag by tag on lines of its own, with twelve specification lines after it: each takes its own arm, so pages
# differ in content and order.
PAGE_TEXT = f"""
SELECT {pick('p_size', ['LYNX 2026 SPEC BOOK.pdf', 'SKI-DOO_2025-PRICE_LIST.pdf', 'SKIDOO_MY24_PRICE_LIST.pdf'])} AS doc,
       CAST(p_partkey AS BIGINT) AS page,
       markup || chr(10) || {" || chr(10) || ".join("(" + pick(f'p_partkey * {m} + p_size * {s} + {i}', LINES) + ")" for i, (m, s) in enumerate([(1, 0), (7, 1), (3, 2), (11, 5), (13, 3), (1, 7), (17, 1), (19, 4), (23, 2), (29, 6), (31, 3), (37, 1)]))} AS text
FROM (SELECT page_id AS p_partkey, length(url) AS p_size, replace(html, '><', '>' || chr(10) || '<') AS markup FROM {{pages}}) p"""

RUN_LOG = f"""
SELECT event_id AS run_id, ts,
       {pick('user_id', ['base_model_matching', 'specification_inheritance', 'customization_processing', 'spring_options_enhancement', 'final_validation'])} AS stage,
       event_type, value * 10 AS duration_ms,
       event_type <> 'error' AS success,
       user_id
FROM {{events}}"""
