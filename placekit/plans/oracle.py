"""DuckDB twins of the registered queries (the correctness oracle).

Each query is plain SQL over the pre-registered source tables.  The fixture
CTEs below rebuild exactly the rows of :mod:`placekit.sources.fixtures`; the
per-row rules are re-stated as SQL expressions, written from the rule
definitions rather than generated from the Spark code.
"""

from __future__ import annotations

from placekit.operators.match import MatchParams, PRODUCTION, GEOGRAPHIC, COORDS_ONLY

# ---------------------------------------------------------------- expressions

def utrim(x: str) -> str:
    return f"regexp_replace({x}, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g')"


def blank(x: str) -> str:
    return f"({x} IS NULL OR {utrim(x)} = '')"


def edit_sim(x: str, y: str) -> str:
    return (f"(CASE WHEN length({x}) = 0 AND length({y}) = 0 THEN 1.0e0 "
            f"WHEN length({x}) = 0 OR length({y}) = 0 THEN 0.0e0 "
            f"ELSE 1.0e0 - levenshtein({x}, {y})::DOUBLE / greatest(length({x}), length({y}))::DOUBLE END)")


def strip_suffix(n: str) -> str:
    s = (f"(CASE WHEN ends_with(lower({n}), ' usd') OR ends_with(lower({n}), ' usa') "
         f"OR ends_with(lower({n}), '-usa') THEN left({n}, length({n}) - 4) "
         f"WHEN ends_with(lower({n}), ' us') THEN left({n}, length({n}) - 3) "
         f"WHEN ends_with({n}, '®') THEN left({n}, length({n}) - 1) "
         f"WHEN ends_with({n}, '(Same Day Delivery)') THEN left({n}, length({n}) - 19) "
         f"ELSE {n} END)")
    return utrim(f"replace({s}, '’', '''')")


def normalize(n: str) -> str:
    return f"replace({strip_suffix(n)}, '&amp;', '&')"


def name_key(norm: str) -> str:
    return (f"replace(lower(CASE WHEN {norm} = 'Domino''s Pizza' THEN 'Domino''s' "
            f"ELSE {norm} END), '''', '')")


def name_uuid(norm: str) -> str:
    h = f"sha256({norm})"
    return (f"concat_ws('-', substr({h}, 1, 8), substr({h}, 9, 4), substr({h}, 13, 4), "
            f"substr({h}, 17, 4), substr({h}, 21, 12))")


def name_sim(a: str, b: str) -> str:
    return (f"(CASE WHEN {blank(a)} OR {blank(b)} THEN 0.0e0 ELSE "
            f"{edit_sim(f'lower({normalize(a)})', f'lower({normalize(b)})')} END)")


def street_component(a: str) -> str:
    t = utrim(a)
    first = utrim(f"string_split({t}, ',')[1]")
    second = utrim(f"string_split({t}, ',')[2]")
    return (f"(CASE WHEN len(string_split({t}, ',')) = 2 "
            f"AND regexp_full_match(replace({second}, '-', ''), '\\p{{Nd}}*') "
            f"AND length({second}) IN (5, 10) "
            f"AND regexp_full_match({first}, '\\p{{L}}{{2}}') THEN '' ELSE {first} END)")


def _norm_street(s: str) -> str:
    return f"trim(regexp_replace(regexp_replace(lower({s}), '[^\\w\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"


def street_sim(a: str, b: str) -> str:
    sa, sb = street_component(a), street_component(b)
    return (f"(CASE WHEN {blank(a)} OR {blank(b)} THEN 0.0e0 "
            f"WHEN {blank(sa)} OR {blank(sb)} THEN 0.0e0 "
            f"ELSE {edit_sim(_norm_street(sa), _norm_street(sb))} END)")


def haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (f"pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) "
         f"* pow(sin(radians({lon2} - {lon1}) / 2), 2)")
    return f"(7918.0e0 * asin(sqrt(least(greatest({a}, 0.0e0), 1.0e0))))"


def coord_score(d: str) -> str:
    return (f"(CASE WHEN {d} <= 0.01e0 THEN 1.0e0 WHEN {d} <= 0.03e0 THEN 0.95e0 "
            f"WHEN {d} <= 0.05e0 THEN 0.85e0 WHEN {d} <= 0.1e0 THEN 0.7e0 "
            f"WHEN {d} <= 0.2e0 THEN 0.5e0 WHEN {d} <= 0.5e0 THEN 0.3e0 ELSE 0.1e0 END)")


def lower_trim_eq(x: str, y: str) -> str:
    return f"coalesce(NOT {blank(x)} AND NOT {blank(y)} AND lower({utrim(x)}) = lower({utrim(y)}), false)"


def zip_eq(x: str, y: str) -> str:
    return f"coalesce(NOT {blank(x)} AND NOT {blank(y)} AND left({utrim(x)}, 5) = left({utrim(y)}, 5), false)"


def confidence(p: MatchParams, d="distance_miles", n="name_similarity", s="address_similarity") -> str:
    geo_ignored = p.geo_ignored
    coord = coord_score(d)
    name = "1.0e0" if p.ignore_name else n
    street = f"(CASE WHEN {s} > 0 THEN {s} ELSE 0.0e0 END)" if geo_ignored else "0.0e0"
    if p.ignore_name:
        conf = f"({coord} * 0.7e0 + {street} * 0.3e0)" if geo_ignored else coord
    else:
        conf = (f"({coord} * 0.5e0 + {name} * 0.3e0 + {street} * 0.2e0)" if geo_ignored
                else f"({coord} * 0.6e0 + {name} * 0.4e0)")
    bonus = "0.0e0"
    if not p.ignore_city:
        bonus += f" + (CASE WHEN {lower_trim_eq('b_city', 'a_city')} THEN 0.05e0 ELSE 0.0e0 END)"
    if not p.ignore_state:
        bonus += f" + (CASE WHEN {lower_trim_eq('b_territory', 'a_territory')} THEN 0.05e0 ELSE 0.0e0 END)"
    if not p.ignore_zip:
        z = p.zip_column
        bonus += f" + (CASE WHEN {zip_eq('b_' + z, 'a_' + z)} THEN 0.02e0 ELSE 0.0e0 END)"
    final = f"least({conf} + ({bonus}), 1.0e0)"
    return (f"(CASE WHEN {coord} < 0.5e0 THEN least({final}, 0.4e0) "
            f"WHEN {coord} < 0.7e0 THEN least({final}, 0.6e0) ELSE {final} END)")


def r6(x: str) -> str:
    return f"round({x}, 6)"


# ---------------------------------------------------------------- fixtures

FX_BASE = """fx_base AS (
  SELECT c_custkey k, p_name || ' ' || p_partkey nm,
    concat(cast(100 + c_custkey % 900 AS VARCHAR), ' ', c_mktsegment, ' Street') addr,
    25.0e0 + ((c_custkey * 7919) % 240000) / 10000.0e0 lat,
    -124.0e0 + ((c_custkey * 104729) % 570000) / 10000.0e0 lon
  FROM customer JOIN part ON p_partkey = c_custkey // 20)"""

PLACE_A = """place_a AS (
  SELECT k row_id, k seq, 'A' || (k % 40) merchantId, nm name,
    CASE WHEN k % 10 = 9 THEN 'online' ELSE addr END address1,
    CASE WHEN k % 10 = 9 THEN NULL ELSE lat END latitude,
    CASE WHEN k % 10 = 9 THEN NULL ELSE lon END longitude,
    'City ' || (k % 50) city, 'State ' || (k % 10) territory,
    CASE WHEN k % 10 = 9 THEN 'online' ELSE 'physical' END type,
    CASE WHEN k % 19 = 0 THEN NULL ELSE CAST((k * 37) % 1000 AS INTEGER) END savingsPercentage,
    CASE WHEN k % 7 = 0 THEN NULL ELSE 'logo-a-' || k END logoLocation,
    'A' source, 'a-' || k sourceId, k % 23 <> 0 active,
    CASE k % 3 WHEN 0 THEN 'barcode' WHEN 1 THEN 'online' END redeemType,
    CASE WHEN k % 2 = 0 THEN 'fixed' ELSE 'min-max' END denominationsType
  FROM fx_base)"""

_B_NAME = """CASE k % 5 WHEN 0 THEN nm || ' USA' WHEN 1 THEN upper(nm) || '®' WHEN 2 THEN nm
      WHEN 3 THEN nm || ' store' ELSE {last} END"""

PLACE_B = f"""place_b AS (
  SELECT k * 2 row_id, k * 2 + 1 seq, 'B' || (k % 40) merchantId,
    {_B_NAME.format(last="' ' || nm || ' '")} name,
    CASE WHEN k % 4 = 0 THEN replace(addr, 'Street', 'St') ELSE addr END address1,
    lat + CASE k % 7 WHEN 0 THEN 0.0e0 WHEN 1 THEN 0.00003e0 WHEN 2 THEN 0.0002e0
      WHEN 3 THEN 0.0006e0 WHEN 4 THEN 0.0011e0 WHEN 5 THEN 0.0025e0 ELSE 0.05e0 END latitude,
    lon longitude,
    CASE WHEN k % 6 = 0 THEN upper('City ' || (k % 50)) WHEN k % 11 = 0 THEN 'Other'
      ELSE 'City ' || (k % 50) END city,
    CASE WHEN k % 9 = 0 THEN NULL ELSE 'State ' || (k % 10) END territory,
    'physical' type, CAST((k * 53) % 1000 AS INTEGER) savingsPercentage,
    'logo-b-' || k logoLocation, 'B' source, 'b-' || k sourceId, true active,
    'barcode' redeemType, CASE WHEN k % 2 = 1 THEN 'min-max' ELSE 'fixed' END denominationsType
  FROM fx_base WHERE k % 3 <> 0 AND k % 10 <> 9
  UNION ALL
  SELECT k * 2 + 1, k * 2, 'B' || k, {_B_NAME.format(last="nm")}, 'online',
    NULL::DOUBLE, NULL::DOUBLE, NULL::VARCHAR, '', 'online',
    CAST((k * 71) % 1000 AS INTEGER), 'logo-b-' || k, 'B', 'b-' || k, true, 'barcode',
    CASE WHEN k % 2 = 1 THEN 'min-max' ELSE 'fixed' END
  FROM fx_base WHERE k % 8 = 5)"""

PLACES = [FX_BASE, PLACE_A, PLACE_B]


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# ---------------------------------------------------------------- matching

_SIDE = "row_id, seq, name, address1, latitude, longitude, city, territory"


def _side(src: str, prefix: str) -> str:
    cols = ", ".join(f"{c} AS {prefix}{c}" for c in _SIDE.split(", "))
    return f"SELECT {cols} FROM {src}"


def _scored(pairs_cte: str, p: MatchParams) -> str:
    """Project name/street similarity and confidence over ``pairs_cte`` and filter."""
    name = "0.0e0" if p.ignore_name else name_sim("b_name", "a_name")
    street = street_sim("b_address1", "a_address1") if (p.include_address and p.geo_ignored) else "0.0e0"
    return (f"SELECT * FROM (SELECT *, {confidence(p)} AS confidence FROM ("
            f"SELECT *, {name} AS name_similarity, {street} AS address_similarity FROM {pairs_cte}) s0) s1 "
            f"WHERE confidence >= {p.min_confidence}e0"
            + ("" if p.ignore_name else f" AND name_similarity >= {p.min_name_similarity}e0"))


def _finish(p: MatchParams, stage: int, reasons: str) -> str:
    return (f"b_row_id, a_row_id, b_seq, a_seq, distance_miles, name_similarity, address_similarity, "
            f"confidence, {reasons} AS reasons, {str(not p.ignore_city).lower()} AS city_match, "
            f"{str(not p.ignore_state).lower()} AS state_match, '' AS geographic_warning, "
            f"{stage} AS match_stage")


def match_ctes(p: MatchParams) -> list[str]:
    """CTEs ``exact_m``, ``prox_m`` and ``matches`` for parameters ``p``."""
    prec = 10 ** p.coordinate_precision
    cell_pairs = (
        f"cell_pairs AS (SELECT *, {haversine('b_latitude', 'b_longitude', 'a_latitude', 'a_longitude')} AS distance_miles "
        f"FROM ({_side('place_b', 'b_')}) b JOIN ({_side('place_a', 'a_')}) a "
        f"ON floor(b_latitude * {prec}.0e0)::BIGINT = floor(a_latitude * {prec}.0e0)::BIGINT "
        f"AND floor(b_longitude * {prec}.0e0)::BIGINT = floor(a_longitude * {prec}.0e0)::BIGINT "
        f"WHERE b_latitude IS NOT NULL AND b_longitude IS NOT NULL "
        f"AND a_latitude IS NOT NULL AND a_longitude IS NOT NULL)")
    cell_keep = (f"cell_keep AS (SELECT * FROM cell_pairs WHERE distance_miles <= {p.max_distance}e0"
                 + ("" if p.ignore_name else f" AND {name_sim('b_name', 'a_name')} >= {p.min_name_similarity}e0")
                 + ")")
    exact = (f"exact_m AS (SELECT {_finish(p, 1, repr(f'truncated_coordinates_{p.coordinate_precision}dp, coordinate_priority_match'))} "
             f"FROM ({_scored('cell_keep', p)}) x)")
    near = (f"near_pairs AS (SELECT * FROM ("
            f"SELECT *, {haversine('a_latitude', 'a_longitude', 'b_latitude', 'b_longitude')} AS distance_miles FROM "
            f"({_side('place_b', 'b_')} WHERE row_id NOT IN (SELECT b_row_id FROM exact_m)) b, "
            f"({_side('place_a', 'a_')} WHERE row_id NOT IN (SELECT a_row_id FROM exact_m)) a "
            f"WHERE b_latitude IS NOT NULL AND b_longitude IS NOT NULL "
            f"AND a_latitude IS NOT NULL AND a_longitude IS NOT NULL) d "
            f"WHERE distance_miles <= {float(p.max_distance)!r}::DOUBLE)")
    reasons = "'coordinate_priority_proximity, distance_' || printf('%.3f', distance_miles) || 'mi'"
    prox_all = f"prox_all AS (SELECT {_finish(p, 2, reasons)} FROM ({_scored('near_pairs', p)}) x)"
    if p.show_all_matches:
        prox = "prox_m AS (SELECT * FROM prox_all)"
    else:
        prox = ("prox_m AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER "
                "(PARTITION BY b_row_id ORDER BY confidence DESC, a_seq) rn FROM prox_all) WHERE rn = 1)")
    matches = "matches AS (SELECT * FROM exact_m UNION ALL SELECT * FROM prox_m)"
    return [cell_pairs, cell_keep, exact, near, prox_all, prox, matches]


PAIR_OUT = ("b_row_id, a_row_id, " + r6("distance_miles") + " AS distance_miles, "
            + r6("name_similarity") + " AS name_similarity, " + r6("address_similarity")
            + " AS address_similarity, " + r6("confidence") + " AS confidence, reasons, city_match, "
            "state_match, geographic_warning, match_stage")


def sql_match(p: MatchParams, table: str = "matches") -> str:
    return with_(*PLACES, *match_ctes(p)) + f"SELECT {PAIR_OUT} FROM {table}"


ORACLE: dict[str, str] = {}


def register(name: str, sql: str) -> None:
    ORACLE[name] = sql


register("match_exact_stage", sql_match(PRODUCTION, "exact_m"))
register("match_proximity_stage", sql_match(PRODUCTION, "prox_m"))
register("match_places", sql_match(PRODUCTION))
register("match_places_geographic", sql_match(GEOGRAPHIC))
register("match_places_coords_only", sql_match(COORDS_ONLY))
register("match_places_best_only", sql_match(PRODUCTION.with_(show_all_matches=False)))
register("coordinate_cell_join", with_(*PLACES, *match_ctes(PRODUCTION)[:2]) +
         "SELECT b_row_id, a_row_id, " + r6("distance_miles") + " AS distance_miles, "
         "'COORDINATE_EXACT' AS match_type, 4 AS coordinate_precision FROM cell_keep")
register("geo_radius_join", with_(*PLACES) +
         "SELECT * FROM (SELECT a.row_id AS a_row_id, b.row_id AS b_row_id, "
         + r6(haversine("a.latitude", "a.longitude", "b.latitude", "b.longitude")) + " AS distance_miles "
         "FROM place_a a, place_b b WHERE a.latitude IS NOT NULL AND a.longitude IS NOT NULL "
         "AND b.latitude IS NOT NULL AND b.longitude IS NOT NULL "
         "AND " + haversine("a.latitude", "a.longitude", "b.latitude", "b.longitude") + " <= 0.2e0) x")


# ---------------------------------------------------------------- consolidation

_ORDER = "o_p, o_m, o_s, o_c, o_a"
_ROWCOLS = ("uid, merchantId, name, address1, latitude, longitude, city, territory, type, "
            "savingsPercentage, logoLocation, source, sourceId, active, redeemType, "
            "denominationsType, plusCode, o_p, o_m, o_s, o_c, o_a")


def consolidate_ctes() -> list[str]:
    norm_a = normalize("name")
    return [
        "mo AS (SELECT *, CASE WHEN match_stage = 2 THEN -confidence ELSE 0.0e0 END nc FROM matches)",
        f"an AS (SELECT *, {norm_a} name_std FROM place_a)",
        f"an2 AS (SELECT *, {name_key('name_std')} nkey FROM an)",
        f"bn AS (SELECT *, {norm_a} name_std FROM place_b)",
        f"bn2 AS (SELECT *, {name_key('name_std')} nkey FROM bn)",
        # dictionary contributions in processing order
        f"""ev AS (
  SELECT nkey, name_std, logoLocation logo, merchantId idc, 0 o_p, o_m, o_s, o_c, o_a, row_id rid
  FROM (SELECT a.*, m.match_stage o_m, m.b_seq o_s, m.nc o_c, m.a_seq o_a,
          row_number() OVER (PARTITION BY m.a_row_id ORDER BY m.match_stage, m.b_seq, m.nc, m.a_seq) rn
        FROM mo m JOIN an2 a ON a.row_id = m.a_row_id) f WHERE rn = 1
  UNION ALL
  SELECT nkey, name_std, logoLocation, coalesce(merchantId, {name_uuid('name_std')}), 1, 0, seq, 0.0e0, 0, row_id
  FROM an2 WHERE row_id NOT IN (SELECT a_row_id FROM matches)
  UNION ALL
  SELECT nkey, name_std, logoLocation, {name_uuid('name_std')}, 2, 0, seq, 0.0e0, 0, row_id
  FROM bn2 WHERE row_id NOT IN (SELECT b_row_id FROM matches))""",
        f"""evl AS (SELECT *, first_value(logo IGNORE NULLS) OVER (PARTITION BY nkey ORDER BY {_ORDER}
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) logo_so_far FROM ev WHERE name_std IS NOT NULL)""",
        f"""dn AS (SELECT nkey, name_std canon_name FROM (SELECT *, row_number() OVER (PARTITION BY nkey ORDER BY {_ORDER}) rn
  FROM evl) x WHERE rn = 1)""",
        f"""di AS (SELECT nkey, idc canon_id FROM (SELECT *, row_number() OVER (PARTITION BY nkey ORDER BY {_ORDER}) rn
  FROM evl WHERE idc IS NOT NULL) x WHERE rn = 1)""",
        f"""dl AS (SELECT nkey, logo first_logo FROM (SELECT *, row_number() OVER (PARTITION BY nkey ORDER BY {_ORDER}) rn
  FROM evl WHERE logo IS NOT NULL) x WHERE rn = 1)""",
        "dict AS (SELECT dn.nkey, canon_name, canon_id, first_logo FROM dn LEFT JOIN di USING (nkey) LEFT JOIN dl USING (nkey))",
        """merged AS (SELECT 'm:' || m.a_row_id || ':' || m.b_row_id uid, a.merchantId, a.name, a.address1,
  a.latitude, a.longitude, a.city, a.territory, a.type,
  greatest(coalesce(a.savingsPercentage, 0), coalesce(b.savingsPercentage, 0)) savingsPercentage,
  a.logoLocation, a.source, a.sourceId, a.active, a.redeemType, a.denominationsType, 'merged' plusCode,
  0 o_p, m.match_stage o_m, m.b_seq o_s, m.nc o_c, m.a_seq o_a
  FROM mo m JOIN place_a a ON a.row_id = m.a_row_id JOIN place_b b ON b.row_id = m.b_row_id)""",
        """una AS (SELECT 'a:' || a.row_id uid, d.canon_id merchantId, d.canon_name name, a.address1,
  a.latitude, a.longitude, a.city, a.territory, a.type, a.savingsPercentage, e.logo_so_far logoLocation,
  a.source, a.sourceId, a.active, a.redeemType, a.denominationsType, NULL::VARCHAR plusCode,
  1 o_p, 0 o_m, a.seq o_s, 0.0e0 o_c, 0 o_a, a.merchantId orig_mid, a.nkey, a.row_id rid
  FROM an2 a JOIN evl e ON e.o_p = 1 AND e.rid = a.row_id LEFT JOIN dict d ON d.nkey = a.nkey)""",
        """unb AS (SELECT 'b:' || b.row_id uid, d.canon_id merchantId, d.canon_name name, b.address1,
  b.latitude, b.longitude, b.city, b.territory, b.type, b.savingsPercentage, e.logo_so_far logoLocation,
  b.source, b.sourceId, b.active, b.redeemType, b.denominationsType, NULL::VARCHAR plusCode,
  2 o_p, 0 o_m, b.seq o_s, 0.0e0 o_c, 0 o_a, b.merchantId orig_mid, b.nkey, b.row_id rid
  FROM bn2 b JOIN evl e ON e.o_p = 2 AND e.rid = b.row_id LEFT JOIN dict d ON d.nkey = b.nkey)""",
        f"""ex AS (SELECT name c, uid, merchantId orig_mid,
  row_number() OVER (PARTITION BY name ORDER BY {_ORDER}) i, count(*) OVER (PARTITION BY name) k
  FROM (SELECT {_ROWCOLS} FROM merged WHERE type = 'online'
        UNION ALL SELECT {_ROWCOLS} FROM una WHERE type = 'online') x)""",
        """pb AS (SELECT name c, uid b_uid, rid, o_s seq, nkey, merchantId canon_id, savingsPercentage sav,
  row_number() OVER (PARTITION BY name ORDER BY o_s) j,
  first_value(uid) OVER (PARTITION BY name ORDER BY o_s) p1
  FROM unb WHERE type = 'online')""",
        "kc AS (SELECT c, max(k) k FROM ex GROUP BY c)",
        """folds AS (SELECT pb.*, coalesce(kc.k, 0) kk,
  CASE WHEN coalesce(kc.k, 0) > 0 THEN ex.uid WHEN pb.j > 1 THEN pb.p1 END target,
  CASE WHEN coalesce(kc.k, 0) > 0 AND pb.j <= kc.k THEN ex.orig_mid ELSE pb.canon_id END link_mid
  FROM pb LEFT JOIN kc ON kc.c = pb.c
  LEFT JOIN ex ON ex.c = pb.c AND kc.k > 0 AND ex.i = ((pb.j - 1) % kc.k) + 1)""",
        """fa AS (SELECT target uid, max(coalesce(sav, 0)) fsav, max(seq) last_seq, any_value(nkey) fkey
  FROM folds WHERE target IS NOT NULL GROUP BY target)""",
        """fl AS (SELECT fa.*, e.logo_so_far flogo, d.canon_name fname, d.canon_id fid
  FROM fa JOIN evl e ON e.o_p = 2 AND e.o_s = fa.last_seq LEFT JOIN dict d ON d.nkey = fa.fkey)""",
        f"""rowsu AS (SELECT {_ROWCOLS} FROM merged UNION ALL SELECT {_ROWCOLS} FROM una
  UNION ALL SELECT {_ROWCOLS} FROM unb WHERE type IS NULL OR type <> 'online'
  UNION ALL SELECT {_ROWCOLS} FROM unb WHERE type = 'online'
    AND uid IN (SELECT b_uid FROM folds WHERE target IS NULL))""",
        """places AS (SELECT r.uid,
  CASE WHEN fl.uid IS NULL THEN r.merchantId ELSE fl.fid END merchantId,
  CASE WHEN fl.uid IS NULL THEN r.name ELSE fl.fname END name,
  r.address1, r.latitude, r.longitude, r.city, r.territory, r.type,
  CASE WHEN fl.uid IS NULL THEN r.savingsPercentage ELSE greatest(coalesce(r.savingsPercentage, 0), fl.fsav) END savingsPercentage,
  CASE WHEN fl.uid IS NULL THEN r.logoLocation ELSE fl.flogo END logoLocation,
  r.source, r.sourceId, r.active, r.redeemType, r.denominationsType, r.plusCode,
  CASE WHEN fl.uid IS NULL THEN r.o_p ELSE 2 END o_p, CASE WHEN fl.uid IS NULL THEN r.o_m ELSE 0 END o_m,
  CASE WHEN fl.uid IS NULL THEN r.o_s ELSE fl.last_seq END o_s,
  CASE WHEN fl.uid IS NULL THEN r.o_c ELSE 0.0e0 END o_c, CASE WHEN fl.uid IS NULL THEN r.o_a ELSE 0 END o_a
  FROM rowsu r LEFT JOIN fl ON fl.uid = r.uid)""",
        """writes AS (
  SELECT a.merchantId mid, a.source provider, a.merchantId sourceId, a.active, a.redeemType,
    a.savingsPercentage, a.denominationsType, 0 w_p, m.match_stage w_m, m.b_seq w_s, m.nc w_c, m.a_seq w_a, 0 w_t
  FROM mo m JOIN place_a a ON a.row_id = m.a_row_id
  UNION ALL
  SELECT a.merchantId, b.source, b.merchantId, b.active, b.redeemType, b.savingsPercentage,
    b.denominationsType, 0, m.match_stage, m.b_seq, m.nc, m.a_seq, 1
  FROM mo m JOIN place_a a ON a.row_id = m.a_row_id JOIN place_b b ON b.row_id = m.b_row_id
  UNION ALL
  SELECT merchantId, source, orig_mid, active, redeemType, savingsPercentage, denominationsType, 1, 0, o_s, 0.0e0, 0, 0
  FROM una
  UNION ALL
  SELECT coalesce(f.link_mid, u.merchantId), u.source, u.orig_mid, u.active, u.redeemType,
    u.savingsPercentage, u.denominationsType, 2, 0, u.o_s, 0.0e0, 0, 0
  FROM unb u LEFT JOIN folds f ON f.rid = u.rid)""",
        """links AS (SELECT mid merchantId, provider, sourceId, active, redeemType, savingsPercentage, denominationsType
  FROM (SELECT *, row_number() OVER (PARTITION BY mid, provider
          ORDER BY w_p DESC, w_m DESC, w_s DESC, w_c DESC, w_a DESC, w_t DESC) rn
        FROM writes WHERE mid IS NOT NULL AND provider IS NOT NULL) x WHERE rn = 1)""",
        f"""dkeyed AS (SELECT p.*, concat_ws('|', coalesce(d.canon_name, p.n2),
    coalesce(printf('%.4f', p.latitude), 'null'), coalesce(printf('%.4f', p.longitude), 'null'),
    coalesce(p.type, 'null')) dedupe_key
  FROM (SELECT *, {normalize('name')} n2 FROM places) p
  LEFT JOIN dict d ON d.nkey = {name_key('p.n2')})""",
        f"""dranked AS (SELECT *, row_number() OVER (PARTITION BY dedupe_key ORDER BY {_ORDER}) drn FROM dkeyed)""",
    ]


def sql_consolidate(select: str) -> str:
    return with_(*PLACES, *match_ctes(PRODUCTION), *consolidate_ctes()) + select


register("standardize_names", with_(*PLACES) +
         f"SELECT source, row_id, name_std, {name_key('name_std')} AS name_key FROM "
         f"(SELECT source, row_id, {normalize('name')} AS name_std FROM "
         f"(SELECT source, row_id, name FROM place_a UNION ALL SELECT source, row_id, name FROM place_b) u) n")
register("brand_dictionary", sql_consolidate(
    "SELECT nkey AS name_key, canon_name, canon_id, first_logo FROM dict"))
register("merged_places", sql_consolidate(
    "SELECT uid, merchantId, name, savingsPercentage, plusCode, logoLocation FROM merged"))
register("unmatched_a", sql_consolidate(
    "SELECT uid, merchantId, name, logoLocation, savingsPercentage FROM una"))
register("unmatched_b", sql_consolidate(
    "SELECT uid, merchantId, name, logoLocation, savingsPercentage FROM unb"))
register("online_fold", sql_consolidate(
    "SELECT rid AS b_row_id, j, kk AS k, target AS target_uid, link_mid AS link_merchantId FROM folds"))
register("combine_feeds", sql_consolidate(
    "SELECT uid, merchantId, name, address1, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, "
    "type, savingsPercentage, logoLocation, source, sourceId, plusCode FROM places"))
register("provider_links", sql_consolidate("SELECT * FROM links"))
register("dedupe_places", sql_consolidate("SELECT uid, dedupe_key FROM dranked WHERE drn = 1"))
register("dropped_duplicates", sql_consolidate("SELECT uid, dedupe_key FROM dranked WHERE drn > 1"))


# ---------------------------------------------------------------- reports

from placekit.operators.match import DESKTOP  # noqa: E402

_VALID = [
    "va AS (SELECT * FROM place_a WHERE latitude IS NOT NULL AND longitude IS NOT NULL)",
    "vb AS (SELECT * FROM place_b WHERE latitude IS NOT NULL AND longitude IS NOT NULL)",
]


def _desktop_ctes() -> list[str]:
    # the matcher CTEs read place_a/place_b; point them at the valid-coordinate rows
    ctes = [c.replace("FROM place_b", "FROM vb").replace("FROM place_a", "FROM va") for c in match_ctes(DESKTOP)]
    return [*PLACES, *_VALID, *ctes]


_TIER = ("CASE WHEN confidence >= 0.9e0 THEN 'HIGH_CONFIDENCE_DUPLICATE' WHEN confidence >= 0.7e0 "
         "THEN 'MEDIUM_CONFIDENCE_DUPLICATE' WHEN confidence >= 0.5e0 THEN 'LOW_CONFIDENCE_DUPLICATE' "
         "ELSE 'POTENTIAL_MATCH' END")

REPORT = f"""report AS (
  SELECT {_TIER} match_type, confidence confidence_score,
    b.name b_name, b.address1 b_address, b.city b_city, b.territory b_state, b.latitude b_lat, b.longitude b_lon,
    a.name a_name, a.address1 a_address, a.city a_city, a.territory a_territory, a.latitude a_lat, a.longitude a_lon,
    distance_miles, name_similarity, address_similarity, city_match, state_match, true zip_match,
    reasons match_reasons, geographic_warning, m.b_row_id, m.a_row_id
  FROM matches m JOIN vb b ON b.row_id = m.b_row_id JOIN va a ON a.row_id = m.a_row_id
  UNION ALL
  SELECT 'B_UNIQUE', 0.0e0, name, address1, city, territory, latitude, longitude,
    NULL, NULL, NULL, NULL, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE,
    false, false, false, NULL, '', row_id, NULL::BIGINT
  FROM vb WHERE row_id NOT IN (SELECT b_row_id FROM matches WHERE confidence >= 0.5e0)
  UNION ALL
  SELECT 'A_UNIQUE', 0.0e0, NULL, NULL, NULL, NULL, NULL::DOUBLE, NULL::DOUBLE,
    name, address1, city, territory, latitude, longitude, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE,
    false, false, false, NULL, '', NULL::BIGINT, row_id
  FROM va WHERE row_id NOT IN (SELECT a_row_id FROM matches WHERE confidence >= 0.5e0))"""

_REPORT_OUT = ", ".join(
    (r6(c) + " AS " + c) if c in ("confidence_score", "b_lat", "b_lon", "a_lat", "a_lon", "distance_miles",
                                 "name_similarity", "address_similarity") else c
    for c in ["match_type", "confidence_score", "b_name", "b_address", "b_city", "b_state", "b_lat", "b_lon",
              "a_name", "a_address", "a_city", "a_territory", "a_lat", "a_lon", "distance_miles",
              "name_similarity", "address_similarity", "city_match", "state_match", "zip_match",
              "match_reasons", "geographic_warning", "b_row_id", "a_row_id"])

register("comparison_report", with_(*_desktop_ctes(), REPORT) + f"SELECT {_REPORT_OUT} FROM report")
register("match_tier_summary", with_(*_desktop_ctes(), REPORT) +
         "SELECT CAST(count_if(match_type = 'HIGH_CONFIDENCE_DUPLICATE') AS BIGINT) high_confidence_duplicate, "
         "CAST(count_if(match_type = 'MEDIUM_CONFIDENCE_DUPLICATE') AS BIGINT) medium_confidence_duplicate, "
         "CAST(count_if(match_type = 'LOW_CONFIDENCE_DUPLICATE') AS BIGINT) low_confidence_duplicate, "
         "CAST(count_if(match_type = 'POTENTIAL_MATCH') AS BIGINT) potential_match, "
         "CAST(count_if(match_type = 'B_UNIQUE') AS BIGINT) unique_b, "
         "CAST(count_if(match_type = 'A_UNIQUE') AS BIGINT) unique_a FROM report")
register("top_matches_sample", with_(*_desktop_ctes()) +
         "SELECT b.name b_name, a.name a_name, round(distance_miles, 6) distance_miles, "
         "round(confidence, 6) confidence, m.b_row_id, m.a_row_id FROM matches m "
         "JOIN vb b ON b.row_id = m.b_row_id JOIN va a ON a.row_id = m.a_row_id "
         "WHERE confidence >= 0.9e0 ORDER BY match_stage, m.b_seq, "
         "CASE WHEN match_stage = 2 THEN -confidence ELSE 0.0e0 END, m.a_seq LIMIT 3")
register("valid_coordinate_profile", with_(*PLACES) +
         "SELECT 'A' feed, CAST(count_if(latitude IS NOT NULL AND longitude IS NOT NULL) AS BIGINT) valid_rows, "
         "count(*) total_rows FROM place_a UNION ALL "
         "SELECT 'B', CAST(count_if(latitude IS NOT NULL AND longitude IS NOT NULL) AS BIGINT), count(*) "
         "FROM place_b")

_DUP_A = ["merchantId", "name", "address1", "address2", "address3", "address4", "latitude", "longitude",
          "website", "phone", "territory", "city", "source", "sourceId"]
_DUP_B = ["merchantId", "name", "address1", "address2", "address3", "address4", "latitude", "longitude",
          "territory", "city", "source", "sourceId"]
_ABSENT = {"address2", "address3", "address4", "website", "phone"}


def _dup_col(alias: str, c: str, prefix: str) -> str:
    if c in _ABSENT:
        return f"NULL::VARCHAR AS {prefix}{c}"
    if c in ("latitude", "longitude"):
        return f"round({alias}.{c}, 6) AS {prefix}{c}"
    return f"{alias}.{c} AS {prefix}{c}"


DUPS = ("dups AS (SELECT " + ", ".join([_dup_col("a", c, "A_") for c in _DUP_A] +
                                      [_dup_col("b", c, "B_") for c in _DUP_B]) +
        " FROM matches m JOIN place_a a ON a.row_id = m.a_row_id JOIN place_b b ON b.row_id = m.b_row_id)")

register("duplicates_table", with_(*PLACES, *match_ctes(PRODUCTION), DUPS) + "SELECT * FROM dups")
register("mismatched_duplicate_names", with_(*PLACES, *match_ctes(PRODUCTION), DUPS) +
         "SELECT A_name, A_latitude, A_longitude, B_name, B_latitude, B_longitude FROM dups WHERE A_name <> B_name")
register("mismatched_duplicate_streets", with_(*PLACES, *match_ctes(PRODUCTION), DUPS) +
         "SELECT A_name, A_address1, A_latitude, A_longitude, B_name, B_address1, B_latitude, B_longitude "
         "FROM dups WHERE A_name <> B_name")
register("sync_report", sql_consolidate(
    "SELECT (SELECT count(DISTINCT merchantId) FROM links) total_merchants, "
    "(SELECT count(*) FROM places) total_locations, (SELECT count(*) FROM matches) merged_locations"))

_ARCH = ("merchantId, CASE WHEN active THEN 1 ELSE 0 END active, name, address1, NULL::VARCHAR address2, "
         "NULL::VARCHAR address3, NULL::VARCHAR address4, round(latitude, 6) latitude, round(longitude, 6) longitude, "
         "NULL::VARCHAR website, NULL::VARCHAR phone, territory, city, source, sourceId, type, redeemType, "
         "CAST(savingsPercentage AS INTEGER) savingsPercentage, denominationsType")
_PROV = f"prov AS (SELECT {_ARCH} FROM place_a UNION ALL SELECT {_ARCH} FROM place_b)"
register("provider_archive", with_(*PLACES, _PROV) + "SELECT * FROM prov")
register("final_archive", sql_consolidate(f"SELECT {_ARCH} FROM places"))
register("count_source_places", with_(*PLACES, _PROV) + "SELECT count(*) n FROM prov WHERE source = 'A'")
register("online_offers_by_savings", sql_consolidate(
    f"SELECT name, savingsPercentage FROM (SELECT {_ARCH} FROM places) f "
    "WHERE source = 'B' AND address1 = 'online' ORDER BY savingsPercentage"))
register("distinct_source_names", with_(*PLACES, _PROV) +
         "SELECT DISTINCT source, name FROM prov WHERE name IS NOT NULL")


# ---------------------------------------------------------------- snapshot changes

def _names(current: bool) -> str:
    base = "concat_ws(' ', p_name, p_brand, CAST(p_partkey AS VARCHAR))"
    if current:
        return (f"curr_names AS (SELECT CASE WHEN p_partkey % 6 = 0 THEN {base} || ' USA' ELSE {base} END name "
                f"FROM part WHERE p_partkey % 13 <> 0)")
    return f"prev_names AS (SELECT {base} name FROM part WHERE p_partkey % 11 <> 0)"


NAMES = [_names(False), _names(True)]

register("keyed_diff", with_(*NAMES) +
         "SELECT 'new' kind, name FROM curr_names WHERE lower(name) NOT IN (SELECT lower(name) FROM prev_names) "
         "UNION ALL SELECT 'removed', name FROM prev_names WHERE lower(name) NOT IN (SELECT lower(name) FROM curr_names)")

_PN = "pn AS (SELECT DISTINCT name FROM prev_names WHERE name IS NOT NULL)"
_CN = "cn AS (SELECT DISTINCT name FROM curr_names WHERE name IS NOT NULL)"
register("new_removed_brands", with_(*NAMES, _PN, _CN) +
         "SELECT 'verbatim' rule, 'new' kind, name FROM cn WHERE name NOT IN (SELECT name FROM pn) "
         "UNION ALL SELECT 'verbatim', 'removed', name FROM pn WHERE name NOT IN (SELECT name FROM cn) "
         f"UNION ALL SELECT 'normalized', 'new', name FROM cn WHERE {normalize('name')} NOT IN "
         f"(SELECT {normalize('name')} FROM pn) "
         f"UNION ALL SELECT 'normalized', 'removed', name FROM pn WHERE {normalize('name')} NOT IN "
         f"(SELECT {normalize('name')} FROM cn)")

_SNAP = [
    "prev_p AS (SELECT row_id, merchantId, name, latitude, longitude, type FROM place_a WHERE row_id % 11 <> 0)",
    "curr_p AS (SELECT row_id, merchantId, CASE WHEN row_id % 6 = 0 THEN upper(name) ELSE name END name, "
    "CASE WHEN row_id % 5 = 0 THEN latitude + 0.00001e0 ELSE latitude END latitude, longitude, type "
    "FROM place_a WHERE row_id % 13 <> 0)",
]
_KEYS = {
    "merchantId": "merchantId",
    "name": utrim("lower(name)"),
    "location": "coalesce(CAST(latitude AS VARCHAR), 'null') || '_' || coalesce(CAST(longitude AS VARCHAR), 'null')",
    "composite": (f"coalesce({utrim('lower(name)')}, 'null') || '_' || coalesce(printf('%.4f', latitude), 'null') "
                  "|| '_' || coalesce(printf('%.4f', longitude), 'null')"),
}
_parts = []
for _s, _k in _KEYS.items():
    _parts.append(f"SELECT '{_s}' strategy, 'new' kind, row_id FROM curr_p WHERE {_k} IS NOT NULL "
                  f"AND {_k} NOT IN (SELECT {_k} FROM prev_p WHERE {_k} IS NOT NULL)")
    _parts.append(f"SELECT '{_s}', 'removed', row_id FROM prev_p WHERE {_k} IS NOT NULL "
                  f"AND {_k} NOT IN (SELECT {_k} FROM curr_p WHERE {_k} IS NOT NULL)")
_parts.append("SELECT 'all', 'new', c.row_id FROM curr_p c WHERE NOT EXISTS (SELECT 1 FROM prev_p p WHERE "
              "p.row_id IS NOT DISTINCT FROM c.row_id AND p.merchantId IS NOT DISTINCT FROM c.merchantId AND "
              "p.name IS NOT DISTINCT FROM c.name AND p.latitude IS NOT DISTINCT FROM c.latitude AND "
              "p.longitude IS NOT DISTINCT FROM c.longitude AND p.type IS NOT DISTINCT FROM c.type)")
_parts.append("SELECT 'all', 'removed', p.row_id FROM prev_p p WHERE NOT EXISTS (SELECT 1 FROM curr_p c WHERE "
              "p.row_id IS NOT DISTINCT FROM c.row_id AND p.merchantId IS NOT DISTINCT FROM c.merchantId AND "
              "p.name IS NOT DISTINCT FROM c.name AND p.latitude IS NOT DISTINCT FROM c.latitude AND "
              "p.longitude IS NOT DISTINCT FROM c.longitude AND p.type IS NOT DISTINCT FROM c.type)")
register("diff_by_strategy", with_(*PLACES, *_SNAP) + " UNION ALL ".join(_parts))

register("latest_snapshot", with_(
    "snaps AS (SELECT DISTINCT 'locations-' || CASE o_orderkey % 3 WHEN 0 THEN 'TESTNET' WHEN 1 THEN 'PRODUCTION' "
    "ELSE 'DEVNET' END || '-' || CASE WHEN o_orderkey % 50 = 0 THEN '2001-13-45' "
    "ELSE strftime(o_orderdate, '%Y-%m-%d') END || '.db' name FROM orders)",
    "parsed AS (SELECT name, regexp_extract(name, '^locations-([A-Z]+)-', 1) mode, "
    "try_strptime(regexp_extract(name, '(\\d{4}-\\d{2}-\\d{2})\\.db$', 1), '%Y-%m-%d')::DATE d FROM snaps)") +
    "SELECT mode, arg_max(name, d) name, strftime(max(d), '%Y-%m-%d') snapshot_date FROM parsed "
    "WHERE d IS NOT NULL AND d <> DATE '1998-08-02' GROUP BY mode")

_FP_COLS = ["merchantId", "provider", "sourceId", "active", "redeemType", "savingsPercentage", "denominationsType"]
_FP_TEXT = "concat_ws(chr(31), " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), chr(0))" for c in _FP_COLS) + ")"
register("content_fingerprint", sql_consolidate(
    f"SELECT count(*) row_count, coalesce(bit_xor(h), 0) hash_xor, CAST(coalesce(sum(h::HUGEINT), 0) AS VARCHAR) hash_sum "
    f"FROM (SELECT ('0x' || substr(sha256({_FP_TEXT}), 1, 12))::BIGINT h FROM links) x"))


# ---------------------------------------------------------------- feed assembly

RAW_BRAND_A = """raw_brand_a AS (
  SELECT p_partkey * 2 seq, CAST(p_partkey AS VARCHAR) id, p_name name, p_partkey % 13 <> 0 enabled,
    CASE WHEN p_size % 10 = 0 THEN 'unknown' WHEN p_size % 2 = 1 THEN 'physical' ELSE 'online' END type,
    CAST(trunc(p_retailprice)::BIGINT % 2000 AS INTEGER) savingsPercentage,
    'logo-' || p_partkey logoUrl, 'site-' || p_partkey website, 'barcode' redeemType, 'fixed' denominationsType
  FROM part
  UNION ALL
  SELECT p_partkey * 2 + 1, CAST(p_partkey AS VARCHAR), upper(p_name), p_partkey % 2 = 0, 'online', 100,
    'logo-' || p_partkey, 'site-' || p_partkey, 'barcode', 'fixed'
  FROM part WHERE p_partkey % 17 = 0)"""

_TERR = ("CASE {k} % 5 WHEN 0 THEN 'NY' WHEN 1 THEN ' Hawaii' WHEN 2 THEN 'New,Hampshire ' "
         "WHEN 3 THEN 'ZZ' ELSE '' END")


def _coord_a(base: str) -> str:
    return (f"CASE WHEN o_orderkey % 9 = 0 THEN NULL WHEN o_orderkey % 11 = 1 THEN 0.0e0 "
            f"ELSE {base} + (o_orderkey % 240000) / 10000.0e0 END")


RAW_LOCATION_A = f"""raw_location_a AS (
  SELECT CAST(o_orderkey AS VARCHAR) id, CAST(o_custkey * 2 AS VARCHAR) merchantId,
    CASE o_orderkey % 11 WHEN 0 THEN 'online' WHEN 1 THEN '' WHEN 2 THEN 'Address 1 TBD'
      ELSE (o_orderkey % 900) || ' Main St' END address1, NULL::VARCHAR address2,
    {_coord_a('25.0e0')} latitude, {_coord_a('-124.0e0')} longitude,
    {_TERR.format(k='o_custkey')} territory, 'City ' || (o_orderkey % 50) city, 'loc-' || o_orderkey sourceId
  FROM orders)"""


def _last(status_pred: str) -> str:
    return (f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) rn "
            f"FROM raw_brand_a WHERE {status_pred}) x WHERE rn = 1")


REGISTRY = [RAW_BRAND_A, f"enabled_b AS ({_last('enabled')})", f"disabled_b AS ({_last('NOT enabled OR enabled IS NULL')})"]


def state_json(x: str) -> str:
    from placekit.functions.regions import STATE_NAMES
    t = utrim(f"replace({x}, ',', ' ')")
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in STATE_NAMES.items())
    return f"(CASE WHEN {x} IS NULL OR {x} = '' THEN NULL ELSE coalesce(CASE {t} {cases} END, {t}) END)"


def state_text(x: str) -> str:
    from placekit.functions.regions import STATE_NAMES
    t = utrim(f"replace({x}, ',', ' ')")
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in STATE_NAMES.items())
    return f"coalesce(CASE {t} {cases} END, {x})"


CAND_A = """cand_a AS (SELECT l.*, b.name bname, b.savingsPercentage bsav, b.logoUrl blogo,
    CASE WHEN b.type = 'physical' THEN 'physical'
      WHEN b.type = 'online' AND l.address1 IS DISTINCT FROM 'online' THEN 'physical'
      WHEN b.type = 'online' THEN 'online' END ptype
  FROM raw_location_a l JOIN enabled_b b ON l.merchantId = b.id)"""
VALID_A = """valid_a AS (SELECT *, CASE WHEN ptype IS NULL THEN false WHEN ptype = 'online' THEN true
    ELSE coalesce(address1, '') <> '' OR coalesce(address2, '') <> ''
      OR latitude IS DISTINCT FROM 0.0e0 OR longitude IS DISTINCT FROM 0.0e0 END valid FROM cand_a)"""
FEED_A = [*REGISTRY, RAW_LOCATION_A, CAND_A, VALID_A]

register("feed_a_brand_registry", with_(*REGISTRY) +
         "SELECT 'enabled' status, id, name, type, savingsPercentage, seq, enabled FROM enabled_b "
         "UNION ALL SELECT 'disabled', id, name, type, savingsPercentage, seq, enabled FROM disabled_b")
register("feed_a_places", with_(*FEED_A) +
         f"SELECT id row_id, merchantId, bname name, address1, round(latitude, 6) latitude, "
         f"round(longitude, 6) longitude, coalesce({state_json('territory')}, '') territory, city, ptype type, "
         f"bsav savingsPercentage, blogo logoLocation, 'A' source, sourceId FROM valid_a "
         f"WHERE valid AND coalesce(bname, '') <> '' AND NOT coalesce(contains(address1, 'Address 1'), false)")
register("feed_a_orphan_locations", with_(*FEED_A) +
         "SELECT DISTINCT merchantId FROM raw_location_a WHERE merchantId NOT IN (SELECT id FROM enabled_b)")
register("feed_a_rejects", with_(*FEED_A) +
         "SELECT id, merchantId, CASE WHEN NOT valid THEN 'invalid_location' ELSE 'invalid_name_or_address' END reason "
         "FROM valid_a WHERE NOT valid OR coalesce(bname, '') = '' OR coalesce(contains(address1, 'Address 1'), false)")

OFFERS = [
    """offers AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_quantity,
    CAST(l_partkey AS VARCHAR) brand_id,
    'Card ' || l_linenumber || CASE WHEN l_quantity = 1 THEN ' (Instant Delivery)'
      WHEN l_quantity = 2 THEN ' (instant delivery)' ELSE '' END name,
    CASE WHEN l_partkey % 3 = 0 AND l_returnflag = 'N' THEN 'Fixed'
      WHEN l_returnflag = 'A' THEN 'Fixed' WHEN l_returnflag = 'R' THEN 'Option' WHEN l_returnflag = 'N' THEN 'Range' END price_type,
    l_discount * 100.0e0 discount_percentage, 'img-' || l_partkey image
  FROM lineitem)""",
    """kept AS (SELECT * FROM offers WHERE NOT (brand_id = '174' AND (contains(name, 'Card 1') OR contains(name, 'Card 2'))))""",
    """ranked AS (SELECT *, contains(lower(name), '(instant delivery)') inst,
    price_type = 'Fixed' AND NOT contains(name, '(instant delivery)') fx_extra,
    coalesce(price_type IN ('Fixed', 'Option'), false) is_fixed,
    row_number() OVER (PARTITION BY brand_id ORDER BY l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_quantity) rn
  FROM kept)""",
    """per_brand AS (SELECT brand_id, count(*) offers, max(discount_percentage) mx,
    max(CASE WHEN inst OR fx_extra THEN discount_percentage END) inst_max,
    min(CASE WHEN inst THEN rn END) inst_rn, min(CASE WHEN NOT is_fixed THEN rn END) range_rn
  FROM ranked GROUP BY brand_id)""",
    """sel AS (SELECT p.brand_id, r.name, r.price_type,
    CASE WHEN inst_rn IS NOT NULL THEN inst_max WHEN range_rn IS NOT NULL THEN r.discount_percentage ELSE mx END discount_percentage,
    r.image, p.offers
  FROM per_brand p JOIN ranked r ON r.brand_id = p.brand_id AND r.rn = coalesce(p.inst_rn, p.range_rn, 1))""",
    """sav AS (SELECT *, CAST(trunc(discount_percentage * 100.0e0) AS INTEGER) - 150 savingsPercentage,
    CASE WHEN price_type = 'Range' THEN 'min-max' ELSE 'fixed' END denominationsType FROM sel)""",
]
register("offer_blocklist", with_(*OFFERS[:2]) + "SELECT brand_id, l_orderkey, l_linenumber, l_suppkey, name FROM kept")
register("offer_selection", with_(*OFFERS) +
         "SELECT brand_id, name, price_type, round(discount_percentage, 6) discount_percentage, image, offers FROM sel")
register("offer_savings", with_(*OFFERS) + "SELECT brand_id, savingsPercentage, denominationsType FROM sav")

FEED_B = [*OFFERS,
          "brand_b AS (SELECT CAST(p_partkey AS VARCHAR) id, CASE WHEN p_partkey % 5 = 0 THEN p_name || ' USA' "
          "ELSE p_name END name FROM part)",
          f"bb AS (SELECT b.id, {strip_suffix('b.name')} pname, s.* FROM brand_b b LEFT JOIN sav s ON s.brand_id = b.id)",
          "okb AS (SELECT * FROM bb WHERE coalesce(pname, '') <> '' AND savingsPercentage >= 0)",
          f"""loc_b AS (SELECT 'loc-' || o_orderkey name, o_orderkey seq, CAST(o_custkey AS VARCHAR) brand_id,
    CASE WHEN o_orderkey % 6 = 0 THEN 'Unknown' ELSE CAST(o_orderkey % 900 AS VARCHAR) END street_number,
    CASE WHEN o_orderkey % 8 = 0 THEN '' WHEN o_orderkey % 48 = 17 THEN NULL ELSE 'Oak Ave' END street, 'City ' || (o_orderkey % 50) city,
    {_TERR.format(k='o_custkey')} state, CASE WHEN o_orderkey % 5 = 0 THEN 'CA' WHEN o_orderkey % 33 = 1 THEN NULL ELSE 'US' END country,
    CASE WHEN o_orderkey % 16 = 0 THEN 0.0e0 ELSE 25.0e0 + (o_orderkey % 240000) / 10000.0e0 END latitude,
    CASE WHEN o_orderkey % 16 = 0 THEN 0.0e0 ELSE -124.0e0 + (o_orderkey % 240000) / 10000.0e0 END longitude,
    'web-' || o_orderkey website FROM orders)""",
          """lj AS (SELECT l.*, o.pname, o.savingsPercentage, o.image, o.denominationsType,
    (coalesce(l.street, '') <> '' AND coalesce(l.street_number, '') <> '' OR coalesce(l.latitude, 0.0e0) <> 0.0e0
      OR coalesce(l.longitude, 0.0e0) <> 0.0e0) AND coalesce(l.country, '') = 'US' good
  FROM loc_b l JOIN okb o ON l.brand_id = o.id)"""]
register("feed_b_places", with_(*FEED_B) +
         "SELECT 'o:' || id row_id, id merchantId, pname name, 'online' address1, NULL::DOUBLE latitude, "
         "NULL::DOUBLE longitude, '' territory, NULL::VARCHAR city, 'online' type, savingsPercentage, "
         "image logoLocation, denominationsType, NULL::VARCHAR website FROM okb UNION ALL "
         "SELECT 'l:' || name, brand_id, pname, CASE WHEN street_number <> 'Unknown' THEN street_number || ' ' || street "
         f"ELSE street END, round(latitude, 6), round(longitude, 6), {state_text('state')}, city, 'physical', "
         "savingsPercentage, image, denominationsType, website FROM lj WHERE good")
register("feed_b_rejects", with_(*FEED_B) +
         "SELECT name, arg_max(brand_id, seq) brand_id, arg_max(CASE WHEN coalesce(country, '') <> 'US' THEN 'other_country' "
         "ELSE 'invalid_location' END, seq) reason FROM lj WHERE NOT good GROUP BY name")
register("feed_b_rejected_brands", with_(*FEED_B) +
         "SELECT id brand_id, pname name, savingsPercentage, CASE WHEN coalesce(pname, '') = '' THEN 'empty_name' "
         "WHEN brand_id IS NULL THEN 'no_offers' ELSE 'negative_discount' END reason FROM bb "
         "WHERE coalesce(pname, '') = '' OR brand_id IS NULL OR savingsPercentage < 0")

_SHEET_VALS = {
    "SOURCE_ID": "p_partkey || '.0'", "NAME": "p_name", "ADDRESS1": "p_type",
    "LATITUDE": "CASE WHEN p_partkey % 5 = 0 THEN 'n/a' ELSE CAST(30.0e0 + p_partkey % 20 AS VARCHAR) END",
    "LONGITUDE": "CAST(-100.0e0 - p_partkey % 50 AS VARCHAR)",
    "TERRITORY": "' ' || p_brand || ' '", "LOGO_LOCATION": "'logo-c-' || p_partkey",
    "PAYMENT_METHOD": "' gift card '", "TYPE": "' physical '",
    "ACTIVE": "CASE p_partkey % 4 WHEN 0 THEN 'TRUE' WHEN 1 THEN 'no' WHEN 2 THEN '1' ELSE 'maybe' END",
    "MERCHANT_ID": "CASE WHEN p_partkey % 3 = 0 THEN 'x-' || p_partkey ELSE p_partkey || '.0' END",
}


def _sheet() -> str:
    from placekit.sources.fixtures import SHEET_COLUMNS
    cols = ", ".join(f"CASE WHEN p_partkey % 29 = 0 THEN '' ELSE {_SHEET_VALS.get(c, chr(39) * 2)} END {c}"
                     for c in SHEET_COLUMNS)
    nonempty = " OR ".join(f"coalesce({c} <> '', false)" for c in SHEET_COLUMNS)
    return [f"sheet AS (SELECT 'r' || p_partkey row_key, {cols} FROM part)",
            f"sheet_ok AS (SELECT * FROM sheet WHERE {nonempty})"]


def _nz(c: str) -> str:
    return f"nullif({c}, '')"


FEED_C = (f"SELECT row_key, coalesce(CAST(CAST(trunc(TRY_CAST({_nz('MERCHANT_ID')} AS DOUBLE)) AS BIGINT) AS VARCHAR), "
          f"{_nz('MERCHANT_ID')}) merchantId, "
          f"CASE WHEN upper({_nz('ACTIVE')}) IN ('TRUE', 'YES', '1') THEN true "
          f"WHEN upper({_nz('ACTIVE')}) IN ('FALSE', 'NO', '0') THEN false END active, "
          f"{_nz('NAME')} name, {_nz('ADDRESS1')} address1, round(TRY_CAST({_nz('LATITUDE')} AS DOUBLE), 6) latitude, "
          f"round(TRY_CAST({_nz('LONGITUDE')} AS DOUBLE), 6) longitude, {utrim(_nz('TERRITORY'))} territory, "
          f"coalesce(CAST(CAST(trunc(TRY_CAST({_nz('SOURCE_ID')} AS DOUBLE)) AS INTEGER) AS VARCHAR), {_nz('SOURCE_ID')}, '0') sourceId, "
          f"{utrim(_nz('TYPE'))} type, {utrim(_nz('PAYMENT_METHOD'))} paymentMethod, {_nz('LOGO_LOCATION')} logoLocation, "
          f"'none' redeemType, 'C' source FROM sheet_ok")
register("feed_c_places", with_(*_sheet()) + FEED_C)
register("feed_c_stats", with_(*_sheet(), f"fc AS ({FEED_C})") +
         "SELECT count(*) rows, count(DISTINCT name) names FROM fc")

register("kiosk_places", with_(
    "k AS (SELECT CAST(s_suppkey AS INTEGER) id, s_name location, 'Addr ' || s_suppkey address, n_name city, "
    "CASE s_suppkey % 3 WHEN 0 THEN 'CA' WHEN 1 THEN '' END state, CAST(s_suppkey % 2 AS INTEGER) buy, "
    "CAST((s_suppkey // 2) % 2 AS INTEGER) sell, CASE WHEN s_suppkey % 10 = 0 THEN NULL ELSE 30.0e0 + s_suppkey % 20 END lat, "
    "CASE WHEN s_suppkey % 10 = 0 THEN NULL ELSE -100.0e0 - s_suppkey % 30 END lng, 'op-' || (s_suppkey % 7) operator, "
    "'https://kiosk/' || s_suppkey url, 'oplogo-' || (s_suppkey % 7) operator_logo, '555-0100' operator_phone "
    "FROM supplier JOIN nation ON s_nationkey = n_nationkey)") +
    f"SELECT '' postcode, operator manufacturer, id kiosk_id, true active, location name, address address1, "
    f"'' address2, '' address3, '' address4, round(coalesce(lat, 0.0e0), 6) latitude, round(coalesce(lng, 0.0e0), 6) longitude, "
    f"url website, operator_phone phone, CASE WHEN coalesce({state_text('state')}, '') = '' THEN city "
    f"ELSE {state_text('state')} END territory, city, 'kiosk' source, CAST(id AS VARCHAR) sourceId, "
    f"operator_logo logoLocation, '' googleMaps, '' coverImage, CASE WHEN buy = 1 AND sell = 1 THEN 'Buy and Sell' "
    f"WHEN sell = 1 THEN 'Sell Only' ELSE 'Buy Only' END type FROM k")


# ---------------------------------------------------------------- standardization

register("standardize_states", with_(RAW_LOCATION_A) +
         f"SELECT id, territory, {state_json('territory')} state_from_json, {state_text('territory')} state_from_text "
         "FROM raw_location_a")
register("street_component", with_(*PLACES) + f"SELECT row_id, address1, {street_component('address1')} street FROM place_b")


def clean_name_sql(n: str) -> str:
    from placekit.functions.names import LEGAL_FORM_WORDS
    s = f"trim(regexp_replace(regexp_replace(lower({utrim(n)}), '[^\\w\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"
    words = ", ".join(f"'{w}'" for w in LEGAL_FORM_WORDS)
    s = f"array_to_string(list_filter(string_split({s}, ' '), lambda w: w NOT IN ({words}) AND w <> ''), ' ')"
    s = f"(CASE WHEN starts_with({s}, 'the ') THEN substr({s}, 5) ELSE {s} END)"
    s = f"(CASE WHEN starts_with({s}, 'a ') THEN substr({s}, 3) ELSE {s} END)"
    return f"(CASE WHEN {n} IS NULL THEN '' ELSE trim({s}) END)"


register("clean_business_names", with_(*PLACES) + f"SELECT row_id, name, {clean_name_sql('name')} clean_name FROM place_b")


def city_std_sql(c: str) -> str:
    from placekit.functions.regions import CITY_ABBREVIATIONS
    s = f"lower({utrim(c)})"
    for full, short in CITY_ABBREVIATIONS:
        s = f"replace({s}, '{full}', '{short}')"
    return s


register("standardize_cities", with_(*PLACES) + f"SELECT row_id, city, {city_std_sql('city')} city_std FROM place_b")

# ---------------------------------------------------------------- blended profile

from placekit.functions.regions import FULL_STATE_TO_ABBR  # noqa: E402
from placekit.operators.match import BLENDED  # noqa: E402


def _state_abbr(x: str) -> str:
    table = ", ".join(f"'{full}': '{short}'" for full, short in FULL_STATE_TO_ABBR.items())
    up = f"upper({utrim(x)})"
    return f"coalesce((MAP {{{table}}})[{up}], {up})"


def _zip_digits(x: str) -> str:
    return f"left({utrim(x)}, 5)"


def blended_confidence(p: MatchParams) -> str:
    """Confidence with the loose city, state and zip rules; addresses do not count in this profile."""
    z = p.zip_column
    city = f"coalesce({city_std_sql('b_city')} = {city_std_sql('a_city')}, false)"
    state = f"coalesce({_state_abbr('b_territory')} = {_state_abbr('a_territory')}, false)"
    code = (f"coalesce(regexp_full_match({_zip_digits('b_' + z)}, '\\p{{Nd}}+') "
            f"AND {_zip_digits('b_' + z)} = {_zip_digits('a_' + z)}, false)")
    coord = coord_score("distance_miles")
    final = (f"least({coord} * 0.6e0 + name_similarity * 0.4e0 + (CASE WHEN {city} THEN 0.05e0 ELSE 0.0e0 END) "
             f"+ (CASE WHEN {state} THEN 0.05e0 ELSE 0.0e0 END) + (CASE WHEN {code} THEN 0.02e0 ELSE 0.0e0 END), 1.0e0)")
    return (f"(CASE WHEN {coord} < 0.5e0 THEN least({final}, 0.4e0) "
            f"WHEN {coord} < 0.7e0 THEN least({final}, 0.6e0) ELSE {final} END)")


# Longest common block of two strings as length * 1000 - start in x: the longest, then the first.
_BLOCK = ("list_max(flatten([[l * 1000 - i for l in range(1, length(x) - i + 2) if contains(y, substring(x, i, l))] "
          "for i in range(1, length(x) + 1)]))")


def blended_ctes(p: MatchParams) -> list[str]:
    prec = f"{10 ** p.coordinate_precision}.0e0"
    cell = " AND ".join(f"floor(b_{c} * {prec})::BIGINT = floor(a_{c} * {prec})::BIGINT" for c in ("latitude", "longitude"))
    clean = lambda c: f"nullif({clean_name_sql(c)}, '')"
    return [
        f"near AS (SELECT *, {haversine('b_latitude', 'b_longitude', 'a_latitude', 'a_longitude')} AS distance_miles, "
        f"{clean('b_name')} AS x, {clean('a_name')} AS y FROM ({_side('vb', 'b_')}) b, ({_side('va', 'a_')}) a "
        f"WHERE distance_miles <= {p.max_distance}e0)",
        "asked AS (SELECT DISTINCT x AS px, y AS py FROM near WHERE x IS NOT NULL AND y IS NOT NULL AND x <> y)",
        # the segments left and right of a pair's longest block, until none has one
        "seg(px, py, x, y, matched) AS (SELECT px, py, px, py, 0::BIGINT FROM asked UNION ALL "
        "SELECT px, py, part.x, part.y, part.matched FROM (SELECT px, py, unnest([{'x': left(x, i - 1), 'y': left(y, j - 1), 'matched': l}, "
        "{'x': substring(x, i + l), 'y': substring(y, j + l), 'matched': 0::BIGINT}]) AS part FROM ("
        "SELECT *, strpos(y, substring(x, i, l)) AS j FROM (SELECT *, l * 1000 - best AS i FROM ("
        "SELECT *, (best + 999) // 1000 AS l FROM ("
        f"SELECT px, py, x, y, {_BLOCK} AS best FROM seg WHERE x <> '' AND y <> '') WHERE best IS NOT NULL)))))",
        "ratio AS (SELECT px, py, 2.0e0 * sum(matched) / (length(px) + length(py)) AS r FROM seg GROUP BY px, py)",
        "named AS (SELECT px, py, CASE WHEN least(length(px), length(py)) / greatest(length(px), length(py)) < 0.3e0 THEN 0.0e0 "
        "WHEN r < 0.3e0 THEN r * 0.4e0 ELSE least(r * 0.5e0 "
        "+ 0.4e0 * len(list_distinct(list_intersect(string_split(px, ' '), string_split(py, ' ')))) "
        "/ len(list_distinct(list_concat(string_split(px, ' '), string_split(py, ' ')))) "
        "+ CASE WHEN len([w for w in string_split(px, ' ') if length(w) > 3 AND contains(py, w)]) > 0 THEN 0.3e0 ELSE 0.0e0 END, "
        "1.0e0) END AS score FROM ratio)",
        "scored AS (SELECT near.*, CASE WHEN x = y THEN 1.0e0 ELSE coalesce(score, 0.0e0) END AS name_similarity, "
        "0.0e0 AS address_similarity FROM near LEFT JOIN named ON px = x AND py = y)",
        f"kept AS (SELECT * FROM (SELECT *, {blended_confidence(p)} AS confidence, {cell} AS same_cell FROM scored) z "
        f"WHERE confidence >= {p.min_confidence}e0 AND name_similarity >= {p.min_name_similarity}e0)",
        f"exact_m AS (SELECT {_finish(p, 1, repr(f'truncated_coordinates_{p.coordinate_precision}dp, coordinate_priority_match'))} "
        "FROM kept WHERE same_cell)",
        "matches AS (SELECT * FROM exact_m UNION ALL SELECT "
        + _finish(p, 2, "'coordinate_priority_proximity, distance_' || printf('%.3f', distance_miles) || 'mi'")
        + " FROM kept WHERE b_row_id NOT IN (SELECT b_row_id FROM exact_m) AND a_row_id NOT IN (SELECT a_row_id FROM exact_m))"]


register("match_places_blended", with_(*PLACES, *_VALID, *blended_ctes(BLENDED)).replace("WITH ", "WITH RECURSIVE ", 1)
         + f"SELECT {PAIR_OUT} FROM matches")

_R3 = "floor({c} * 1000.0e0 + 0.5e0) / 1000.0e0"
register("gazetteer_enrich", with_(
    *PLACES,
    "gaz AS (SELECT 'City ' || k city, 'State ' || (k % 10) state, lat, lon FROM fx_base)",
    f"rb AS (SELECT row_id, {_R3.format(c='latitude')} rlat, {_R3.format(c='longitude')} rlon FROM place_b)",
    "pts AS (SELECT DISTINCT rlat, rlon FROM rb WHERE rlat IS NOT NULL AND rlon IS NOT NULL)",
    f"cand AS (SELECT rlat, rlon, city, state, {haversine('lat', 'lon', 'rlat', 'rlon')} d FROM pts, gaz)",
    "best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY rlat, rlon ORDER BY d, city, state) rn "
    "FROM cand) x WHERE rn = 1)") +
    "SELECT rb.row_id, coalesce(best.city, '') corrected_city, coalesce(best.state, '') corrected_state "
    "FROM rb LEFT JOIN best ON best.rlat = rb.rlat AND best.rlon = rb.rlon")

_SR = [*FEED_A, *FEED_B,
       "prev_a AS (SELECT DISTINCT name FROM raw_brand_a WHERE CAST(id AS BIGINT) % 11 <> 0 AND seq % 2 = 0 AND name IS NOT NULL)",
       "curr_a AS (SELECT DISTINCT name FROM raw_brand_a WHERE enabled AND name IS NOT NULL)",
       "prev_b AS (SELECT DISTINCT name FROM brand_b WHERE CAST(id AS BIGINT) % 11 <> 0 AND name IS NOT NULL)",
       "curr_b AS (SELECT DISTINCT name FROM brand_b WHERE name IS NOT NULL)",
       f"""lists AS (
  SELECT 'A' source, 'disabled' list, name FROM disabled_b
  UNION ALL SELECT 'A', 'new', name FROM curr_a WHERE name NOT IN (SELECT name FROM prev_a)
  UNION ALL SELECT 'A', 'removed', name FROM prev_a WHERE name NOT IN (SELECT name FROM curr_a)
  UNION ALL SELECT 'B', 'new', name FROM curr_b WHERE {normalize('name')} NOT IN (SELECT {normalize('name')} FROM prev_b)
  UNION ALL SELECT 'B', 'removed', name FROM prev_b WHERE {normalize('name')} NOT IN (SELECT {normalize('name')} FROM curr_b)
  UNION ALL SELECT 'B', 'negative', pname FROM bb WHERE coalesce(pname, '') <> '' AND savingsPercentage < 0)"""]
register("source_report_lists", with_(*_SR) + "SELECT source, list, name FROM lists")
register("source_report", with_(*_SR) +
         "SELECT 'A' source, (SELECT count(*) FROM enabled_b) brands, (SELECT count(*) FROM valid_a WHERE valid) locations, "
         "(SELECT count(*) FROM lists WHERE source = 'A' AND list = 'disabled') disabled, "
         "(SELECT count(*) FROM lists WHERE source = 'A' AND list = 'new') new_brands, "
         "(SELECT count(*) FROM lists WHERE source = 'A' AND list = 'removed') removed_brands, 0 negative_discount "
         "UNION ALL SELECT 'B', (SELECT count(*) FROM brand_b), (SELECT count(*) FROM lj WHERE good), 0, "
         "(SELECT count(*) FROM lists WHERE source = 'B' AND list = 'new'), "
         "(SELECT count(*) FROM lists WHERE source = 'B' AND list = 'removed'), "
         "(SELECT count(*) FROM lists WHERE source = 'B' AND list = 'negative')")

register("explore_table", sql_consolidate(
    "SELECT 0 part, coalesce(merchantId, '') merchantId, coalesce(active, false) active, name, address1, "
    "round(coalesce(latitude, 0.0e0), 6) latitude, round(coalesce(longitude, 0.0e0), 6) longitude, source, "
    "coalesce(sourceId, '') sourceId, type, coalesce(redeemType, 'none') redeemType, 0 savingsPercentage, "
    "NULL::VARCHAR plusCode, logoLocation FROM fcx "
    "UNION ALL SELECT 1, coalesce(merchantId, ''), coalesce(active, false), name, address1, "
    "round(coalesce(latitude, 0.0e0), 6), round(coalesce(longitude, 0.0e0), 6), source, coalesce(sourceId, ''), "
    "type, coalesce(redeemType, 'none'), coalesce(savingsPercentage, 0), plusCode, logoLocation FROM places"
).replace("WITH ", "WITH " + ",\n".join(_sheet()) + f",\nfcx AS ({FEED_C}),\n", 1))


# ---------------------------------------------------------------- sources and sinks round trips

register("csv_round_trip", sql_consolidate(
    "SELECT merchantId, name, address1, round(latitude, 6) latitude, round(longitude, 6) longitude, type, "
    "savingsPercentage, logoLocation, source, sourceId, plusCode, active, redeemType FROM places"))
register("snapshot_scan", with_(*PLACES, _PROV) + "SELECT * FROM prov WHERE source = 'A'")

register("nonempty_guard", ORACLE["provider_archive"])
register("detect_coordinate_columns", with_(*PLACES) +
         "SELECT row_id, 'Latitude' lat_column, 'lng' lon_column, round(latitude, 6) lat, round(longitude, 6) lon FROM place_b")
register("read_feed_json", with_(RAW_BRAND_A) +
         "SELECT seq, id, name, enabled, type, savingsPercentage, logoUrl, NULL::VARCHAR deeplink FROM raw_brand_a")
register("read_sheet_csv", "SELECT merchantId, active, name, address1, latitude, longitude, territory, sourceId, type, "
         "paymentMethod, logoLocation FROM (" + ORACLE["feed_c_places"] + ") x")
register("publish_if_changed", with_(*PLACES) +
         "SELECT source, sourceId, CASE WHEN d = 1 THEN name END name, CASE WHEN d = 2 THEN name END other, "
         "'2024-01-0' || d snapshot_date FROM (SELECT source, sourceId, name FROM place_a UNION ALL "
         "SELECT source, sourceId, name FROM place_b) p, (SELECT unnest([1, 2]) d) dates")
register("archive_sql", sql_consolidate(
    "SELECT source, count(*) places, count(DISTINCT name) names, "
    "(SELECT count(*) FROM matches m JOIN place_a a ON a.row_id = m.a_row_id JOIN place_b b ON b.row_id = m.b_row_id "
    "WHERE a.name <> b.name) mismatched "
    "FROM (SELECT source, name FROM place_a UNION ALL SELECT source, name FROM place_b) p GROUP BY source"))
