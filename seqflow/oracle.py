"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each entry reads the driver's views (lineitem, events, labels, ...) and must produce
the same columns, names and values as the Spark query of the same key. Doubles are
rounded to 6 places on both sides. The SQL is assembled from small text templates.
"""

from __future__ import annotations

R = 6  # decimal places for double outputs
# Sample standard deviations are computed by different (equally valid) update formulas in
# the two engines; on values near 1e5 they differ in the 11th significant digit, so
# `*_moving_std` outputs are compared at 4 places.
R_STD = 4


def places(name: str) -> int:
    return R_STD if name.endswith("moving_std") else R

SIGNALS = ("first_param", "second_param", "third_param")
ORDER = "l_shipdate, l_orderkey, l_partkey, second_param"

# lineitem -> measurement rows; subpart stored as tenths when raw.
MEASURE = """SELECT CAST(l_suppkey AS VARCHAR) AS part_number,
       CAST(l_linenumber AS DOUBLE) {sub} AS subpart_no,
       l_shipdate, l_orderkey, l_partkey,
       l_quantity AS first_param, l_extendedprice AS second_param,
       l_discount AS third_param, l_tax AS machine_position,
       CASE WHEN l_suppkey % 5 IN (0,1,2) THEN 'NG' ELSE 'OK' END AS files_type,
       CASE l_suppkey % 5 WHEN 0 THEN '3,4' WHEN 1 THEN '3' WHEN 2 THEN 'x7' END AS valve_raw
FROM lineitem"""


def measure(raw: bool = False) -> str:
    return MEASURE.format(sub="/ 10" if raw else "")


VALVE = "CASE WHEN regexp_full_match(valve_raw, '[0-9](,[0-9])*') THEN valve_raw END"


def status(subpart: str = "subpart_no") -> str:
    v = VALVE
    return (f"CASE WHEN files_type = 'OK' THEN 'OK' WHEN ({v}) IS NULL THEN 'NG' "
            f"WHEN list_has_any(string_split({v}, ','), string_split(CAST({subpart} AS VARCHAR), '')) THEN 'NG' "
            f"ELSE 'OK_within_NG' END")


def labelled(raw: bool = True) -> str:
    """Measurement rows with `ng_valve_no` and the text label, as the folder ingest emits them."""
    return (f"SELECT part_number, subpart_no, l_shipdate, l_orderkey, l_partkey, first_param, second_param, "
            f"third_param, machine_position, {VALVE} AS ng_valve_no, {status()} AS subpart_label "
            f"FROM ({measure(raw)})")


def normalized(src: str) -> str:
    return (f"SELECT * REPLACE (CASE WHEN subpart_no BETWEEN 0 AND 0.6 THEN subpart_no * 10 ELSE subpart_no END "
            f"AS subpart_no) FROM ({src}) WHERE (CASE WHEN subpart_no BETWEEN 0 AND 0.6 THEN subpart_no * 10 "
            f"ELSE subpart_no END) <> 0 OR subpart_no IS NULL")


def length_filtered(src: str, k: int = 7, steps: int = 86) -> str:
    lo, hi = k * steps * 0.9, k * steps * 1.1
    return (f"SELECT * FROM ({src}) WHERE part_number IN (SELECT part_number FROM ({src}) "
            f"WHERE part_number IS NOT NULL GROUP BY part_number HAVING count(*) > {lo!r} AND count(*) < {hi!r})")


def indexed(src: str) -> str:
    return (f"SELECT *, CAST(row_number() OVER (PARTITION BY part_number, subpart_no ORDER BY {ORDER}) AS DOUBLE) "
            f"AS subpart_index FROM ({src})")


def padded(src: str, t: str) -> str:
    """Pad every (part, subpart) to T = scalar `t` by copying the last row (keeps helper columns)."""
    return f"""SELECT *, unnest(CASE WHEN subpart_index = last_i AND n_i < ({t}) AND subpart_index < ({t})
                        THEN generate_series(CAST(subpart_index AS BIGINT), CAST(({t}) AS BIGINT))
                        ELSE [CAST(subpart_index AS BIGINT)] END) AS step
  FROM (SELECT *, count(*) OVER g AS n_i, max(subpart_index) OVER g AS last_i FROM ({src})
        WHERE part_number IS NOT NULL AND subpart_no IS NOT NULL
        WINDOW g AS (PARTITION BY part_number, subpart_no))"""


def padded_clean(src: str, t: str) -> str:
    return (f"SELECT * EXCLUDE (n_i, last_i, step) REPLACE (CAST(step AS DOUBLE) AS subpart_index) "
            f"FROM ({padded(src, t)})")


def part_indexed(src: str) -> str:
    return (f"SELECT *, CAST(row_number() OVER (PARTITION BY part_number ORDER BY subpart_no ASC NULLS FIRST, "
            f"subpart_index) AS DOUBLE) AS part_index FROM ({src})")


def prepared_train(k: int = 7, steps: int = 86) -> str:
    """The train-mode preparation job on labelled measurement rows."""
    base = indexed(length_filtered(normalized(labelled(True)), k, steps))
    t = f"SELECT CAST(coalesce(max(subpart_index), 0) AS INTEGER) FROM ({base})"
    pad = part_indexed(padded_clean(base, t))
    return (f"SELECT * REPLACE (CASE subpart_label WHEN 'NG' THEN 1.0 WHEN 'OK' THEN 0.0 END::DOUBLE AS subpart_label) "
            f"FROM ({pad}) WHERE subpart_label IS DISTINCT FROM 'OK_within_NG'")


def gradient(x: str, prev: str, nxt: str, rn: str = "rn__", n: str = "n__") -> str:
    return (f"CASE WHEN {n} = 1 THEN NULL WHEN {rn} = 1 THEN {nxt} - {x} WHEN {rn} = {n} THEN {x} - {prev} "
            f"ELSE ({nxt} - {prev}) / 2 END")


def signal_features(src: str, signals=SIGNALS, keys: str = "part_number, subpart_no", order: str = "subpart_index",
                    window_size: int = 3, abs_cumsum=()) -> str:
    """The six features per signal, as in `add_signal_features`."""
    lo, hi = -(window_size // 2), (window_size - 1) // 2
    fr = f"ROWS BETWEEN {-lo} PRECEDING AND {hi} FOLLOWING" if lo < 0 else f"ROWS BETWEEN CURRENT ROW AND {hi} FOLLOWING"
    l1 = ["row_number() OVER w AS rn__", "count(*) OVER (PARTITION BY " + keys + ") AS n__"]
    for s in signals:
        l1 += [f"lag({s}) OVER w AS {s}__p", f"lead({s}) OVER w AS {s}__n",
               f"avg({s}) OVER (w {fr}) AS {s}_moving_average",
               f"stddev_samp({s}) OVER (w {fr}) AS {s}_moving_std",
               f"CASE WHEN row_number() OVER w = 1 THEN {s} - {s} ELSE {s} - lag({s}) OVER w END AS {s}_neighbor_diff"]
    q1 = f"SELECT *, {', '.join(l1)} FROM ({src}) WINDOW w AS (PARTITION BY {keys} ORDER BY {order})"
    l2 = []
    for s in signals:
        term = f"abs({s}_neighbor_diff)" if s in abs_cumsum else f"{s}_neighbor_diff"
        l2 += [f"{gradient(s, s + '__p', s + '__n')} AS {s}_velocity",
               f"CASE WHEN {s}_neighbor_diff IS NOT NULL THEN sum({term}) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING "
               f"AND CURRENT ROW) END AS {s}_neighbor_diff_cumsum"]
    q2 = f"SELECT *, {', '.join(l2)} FROM ({q1}) WINDOW w AS (PARTITION BY {keys} ORDER BY {order})"
    l3 = [f"{gradient(s + '_velocity', f'lag({s}_velocity) OVER w', f'lead({s}_velocity) OVER w')} AS {s}_acceleration"
          for s in signals]
    q3 = f"SELECT *, {', '.join(l3)} FROM ({q2}) WINDOW w AS (PARTITION BY {keys} ORDER BY {order})"
    drop = ["rn__", "n__"] + [f"{s}__p" for s in signals] + [f"{s}__n" for s in signals]
    return f"SELECT * EXCLUDE ({', '.join(drop)}) FROM ({q3})"


def all_features(src: str) -> str:
    f = signal_features(src)
    return (f"SELECT *, sqrt(third_param * third_param + second_param * second_param + first_param * first_param) "
            f"AS magnitude FROM ({f})")


def rnd(expr: str, alias: str) -> str:
    return f"round({expr}, {places(alias)}) AS {alias}"


# ---------------------------------------------------------------- sequences, scaling, metrics

def chunked(src: str, t: str, keys: str = "part_number") -> str:
    """Rows of complete chunks of T rows per `keys` (row number by part_index), with
    chunk, step, chunk label and group id from the chunk's last row."""
    return f"""SELECT * EXCLUDE (lab, rn_, n_, t_) REPLACE (lab AS subpart_label) FROM (
  SELECT *, last_value(subpart_label) OVER c AS lab,
         part_number || '#' || CAST(last_value(subpart_no) OVER c AS VARCHAR) AS group_id
  FROM (SELECT *, (rn_ - 1) // t_ AS chunk, (rn_ - 1) % t_ + 1 AS step FROM (
          SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY part_index) AS rn_,
                 count(*) OVER (PARTITION BY {keys}) AS n_, CAST(({t}) AS BIGINT) AS t_ FROM ({src})))
  WHERE chunk < n_ // t_
  WINDOW c AS (PARTITION BY {keys}, chunk ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))"""


def groups_of(src: str) -> str:
    return f"SELECT part_number, subpart_no, max(subpart_label) AS subpart_label FROM ({src}) GROUP BY 1, 2"


def md5_key(seed: int = 42) -> str:
    return f"md5('{seed}#' || part_number || '#' || CAST(subpart_no AS VARCHAR))"


def uniform(seed: int = 42) -> str:
    return f"(('0x' || substr({md5_key(seed)}, 1, 8))::BIGINT / 4294967296.0)"


def split(src: str, p_train: float, p_val: float, seed: int = 42) -> str:
    return f"""SELECT part_number, subpart_no, subpart_label,
  CASE WHEN rk <= floor(tot * {p_train!r}) THEN 'train'
       WHEN rk <= floor(tot * {p_train!r}) + floor((tot - floor(tot * {p_train!r})) * {p_val!r}) THEN 'val'
       ELSE 'test' END AS split
FROM (SELECT *, row_number() OVER (PARTITION BY subpart_label ORDER BY {md5_key(seed)}, part_number, subpart_no) AS rk,
             count(*) OVER (PARTITION BY subpart_label) AS tot FROM ({groups_of(src)}))"""


def runlog() -> str:
    """events -> one run log row per (user, event): epochs numbered from 1 by time."""
    return """SELECT CAST(user_id AS VARCHAR) AS run_id,
  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS epoch,
  value / 100.0 AS val_loss, value / 90.0 AS train_loss,
  ((event_id * 7) % 100) / 100.0 AS f2_ng, ((event_id * 13) % 100) / 100.0 AS recall_ng,
  ((event_id * 17) % 50) / 50.0 AS precision_ng, ((event_id * 19) % 40) / 40.0 AS precision_ok
FROM events"""


def scored_events() -> str:
    return """SELECT event_type AS machine, CAST(user_id AS VARCHAR) AS part_number,
  CAST(event_id % 7 + 1 AS DOUBLE) AS subpart_no, value / (1 + value) AS prob,
  CASE WHEN value > 0 THEN ln(value) END AS logit,
  CAST(CASE WHEN event_type = 'purchase' THEN 1.0 ELSE 0.0 END AS DOUBLE) AS real_label, user_id, ts, event_id
FROM events"""


def bce(z: str, y: str, w: float | None = None) -> str:
    sp = f"ln(1 + exp(-abs({z})))"
    if w is None:
        return f"(greatest({z}, 0) - {z} * {y} + {sp})"
    return f"((1 - {y}) * {z} + (1 + ({w!r} - 1) * {y}) * ({sp} + greatest(-{z}, 0)))"


def focal(z: str, y: str, gamma: float = 2.0, alpha: float = 0.5, dynamic: bool = False) -> str:
    b = bce(z, y)
    a = f"CASE WHEN {y} = 1.0 THEN {alpha!r} ELSE {1.0 - alpha!r} END" if dynamic else repr(alpha)
    return f"({a} * pow(1 - exp(-{b}), {gamma!r}) * {b})"


def sequences_train(src: str, t: str, feats) -> str:
    """Train-mode sequence preparation: per chunk label, group id, class weight, step
    count and the sum of the scaled first feature."""
    stats = ", ".join(f"avg({f}) AS {f}_m, CASE WHEN stddev_pop({f}) = 0 THEN 1.0 ELSE stddev_pop({f}) END AS {f}_s"
                      for f in feats)
    f0 = feats[0]
    return f"""WITH c AS ({chunked(src, t)}), s AS (SELECT {stats} FROM c),
q AS (SELECT part_number, chunk, max(subpart_label) AS subpart_label, max(group_id) AS group_id,
        count(*) AS n_steps, sum((c.{f0} - s.{f0}_m) / s.{f0}_s) AS sum_first_scaled
      FROM c CROSS JOIN s GROUP BY part_number, chunk)
SELECT part_number, chunk, subpart_label, group_id, n_steps, round(sum_first_scaled, 6) AS sum_first_scaled,
  round(1.0 / count(*) OVER (PARTITION BY subpart_label), 6) AS weight FROM q"""
