"""Frame statistics over a table with one row per sensor frame.

Input columns: ``episode_id``, ``frame_index``, ``timestamp_ns``, ``positions``
and ``velocities`` (arrays, NULL elements allowed), ``task_type`` and optionally
``chunk``. Frames are shuffled once, by (episode, chunk): an ordinary episode is
one chunk, a very long one is many. Windows and aggregates run inside a chunk,
and chunk summaries (about one row per 65,536 frames) are merged per episode.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.functions import arrays, scoring
from gaugeline.functions.arrays import JOINTS, number
from gaugeline.operators.ordered import FRAMES_PER_CHUNK, neighbours


def with_chunk(frames: DataFrame, size: int = FRAMES_PER_CHUNK) -> DataFrame:
    """Use the given ``chunk`` column, or cut by position in the episode.

    A row without an episode or a position is no frame. The explicit shuffle is
    the one the windows need anyway; naming it lets operators that look at the
    frames twice share it.
    """
    if "chunk" in frames.columns:
        return frames
    return (
        frames.where("episode_id IS NOT NULL AND frame_index IS NOT NULL")
        .selectExpr("*", f"coalesce(cast(frame_index AS bigint) DIV {size}, 0L) AS chunk")
        .repartition("episode_id", "chunk")
    )


def explode_frames(episodes: DataFrame) -> DataFrame:
    """Nested episodes to frame rows; an episode without frames gives no row."""
    return episodes.selectExpr(
        "episode_id", "task_type", "posexplode(sensor_frames) AS (frame_index, f)"
    ).selectExpr(
        "episode_id",
        "task_type",
        "frame_index",
        "f.timestamp_ns AS timestamp_ns",
        "f.joint_positions AS positions",
        "f.joint_velocities AS velocities",
    )


def explode_joints(frames: DataFrame) -> DataFrame:
    """Frame rows to one row per joint reading."""
    return frames.selectExpr(
        "episode_id",
        "frame_index",
        "posexplode(arrays_zip(positions, velocities)) AS (joint, r)",
    ).selectExpr(
        "episode_id",
        "frame_index",
        "joint",
        "r.positions AS position",
        "r.velocities AS velocity",
    )


def squared_changes(now: str, before: str) -> str:
    """Exact sum of squared differences of readings present on both sides."""
    change = f"get({now}, {{j}}) - get({before}, {{j}})"
    more = (
        f"CASE WHEN size({now}) > {JOINTS} THEN aggregate(zip_with("
        f"slice({now}, {JOINTS + 1}, size({now})), slice({before}, {JOINTS + 1}, size({now})),"
        f" (a, b) -> coalesce({arrays.square('a - b')}, {arrays.NO_SQUARES})),"
        f" {arrays.NO_SQUARES}, (acc, d) -> {arrays.exact_sum(['acc', 'd'])})"
        f" ELSE {arrays.NO_SQUARES} END"
    )
    squares = [
        f"coalesce({arrays.square(change.format(j=j))}, {arrays.NO_SQUARES})" for j in range(JOINTS)
    ]
    return f"coalesce({arrays.exact_sum([*squares, more])}, {arrays.NO_SQUARES})"


def compared(now: str, before: str) -> str:
    """Number of readings present on both sides."""
    more = (
        f"CASE WHEN size({now}) > {JOINTS} THEN size(filter(zip_with("
        f"slice({now}, {JOINTS + 1}, size({now})), slice({before}, {JOINTS + 1}, size({now})),"
        " (a, b) -> a - b), d -> d IS NOT NULL)) ELSE 0 END"
    )
    both = arrays.per_joint(f"int(get({now}, {{j}}) - get({before}, {{j}}) IS NOT NULL)")
    return f"coalesce({both} + {more}, 0)"


def checked(positions: str) -> str:
    return arrays.per_joint(f"int(get({positions}, {{j}}) IS NOT NULL)")


def over_limit(positions: str, scale: str) -> str:
    return " + ".join(
        f"int(coalesce(abs(get({positions}, {j})) > {number(limit)} * {scale}, false))"
        for j, limit in enumerate(scoring.JOINT_LIMITS)
    )


def jumps(now: str, before: str) -> str:
    moved = f"abs(get({now}, {{j}}) - get({before}, {{j}})) > {number(scoring.MAX_JUMP_RAD)}"
    return arrays.per_joint(f"int(coalesce({moved}, false))")


def frame_measures(frames: DataFrame) -> DataFrame:
    """Per-frame counts, with the previous frame taken inside the chunk."""
    order = "OVER (PARTITION BY episode_id, chunk ORDER BY frame_index"
    so_far = f"{order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    earlier = f"{order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return (
        with_chunk(frames)
        .selectExpr(
            "episode_id",
            "chunk",
            "frame_index",
            "timestamp_ns",
            f"{scoring.TASK_SCALE_OF} AS task_scale",
            f"{arrays.readings('positions')} AS positions",
            f"{arrays.readings('velocities')} AS velocities",
        )
        .selectExpr(
            "*",
            "size(positions) + size(velocities) AS n_values",
            f"{arrays.count_null('positions')} + {arrays.count_null('velocities')} AS n_null",
        )
        .selectExpr(
            "*",
            f"row_number() {order}) AS nth",
            f"lag(velocities) {order}) AS velocities_before",
            f"lag(positions) {order}) AS positions_before",
            f"last(timestamp_ns, true) {earlier} AS stamp_before",
        )
        .selectExpr("*", "CASE WHEN n_null = 0 THEN nth END AS whole_nth")
        .selectExpr("*", f"max(whole_nth) {so_far} AS last_whole_nth")
        .selectExpr(
            "episode_id",
            "chunk",
            "nth",
            "positions",
            "velocities",
            "timestamp_ns",
            "n_values",
            "n_null",
            "whole_nth",
            "nth - coalesce(last_whole_nth, 0) AS null_run",
            "timestamp_ns - stamp_before AS gap_ns",
            f"{squared_changes('velocities', 'velocities_before')} AS sum_sq",
            f"{compared('velocities', 'velocities_before')} AS n_pairs",
            f"{checked('positions')} AS n_checked",
            f"{over_limit('positions', 'task_scale')} AS n_hard",
            f"{jumps('positions', 'positions_before')} AS n_jumps",
        )
    )


def chunk_summaries(measures: DataFrame) -> DataFrame:
    stamped = "CASE WHEN timestamp_ns IS NOT NULL THEN nth END"
    aggregates = [
        "count(*) AS n_frames",
        "sum(n_values) AS n_values",
        "sum(n_null) AS n_null",
        "max(null_run) AS max_run",
        "min(whole_nth) AS first_whole",
        "max(whole_nth) AS last_whole",
        "count(timestamp_ns) AS n_stamps",
        f"min_by(timestamp_ns, {stamped}) AS first_ns",
        f"max_by(timestamp_ns, {stamped}) AS last_ns",
        "max(gap_ns) AS max_gap_ns",
        f"count_if(gap_ns > {scoring.MAX_GAP_NS}) AS n_bad_gaps",
        f"cast(sum(sum_sq) AS {arrays.SQUARES}) AS sum_sq",
        "sum(n_pairs) AS n_pairs",
        "sum(n_checked) AS n_checked",
        "sum(n_hard) AS n_hard",
        "sum(n_jumps) AS n_jumps",
        "min_by(positions, nth) AS head_positions",
        "max_by(positions, nth) AS tail_positions",
        "min_by(velocities, nth) AS head_velocities",
        "max_by(velocities, nth) AS tail_velocities",
    ]
    return measures.groupBy("episode_id", "chunk").agg(*[F.expr(a) for a in aggregates])


def merge_chunks(summaries: DataFrame) -> DataFrame:
    """One row per episode: sums plus what happens across chunk borders.

    ``dead`` counts the frames of chunks without a single whole frame. The null
    run that enters a chunk is the null tail of the last chunk that has a whole
    frame, plus all dead frames since.
    """
    order = "OVER (PARTITION BY episode_id ORDER BY chunk"
    so_far = f"{order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    earlier = f"{order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    border_gap = f"border_gap > {scoring.MAX_GAP_NS}"
    linked = (
        summaries.selectExpr(
            "*",
            "coalesce(first_whole - 1, n_frames) AS lead_run",
            f"sum(CASE WHEN first_whole IS NULL THEN n_frames ELSE 0 END) {so_far} AS dead",
        )
        .selectExpr("*", "n_frames - last_whole - dead AS tail_over_dead")
        .selectExpr(
            "*",
            f"row_number() {order}) AS nth",
            f"""coalesce(lag(dead) {order}), 0)
                + coalesce(last(tail_over_dead, true) {earlier}, 0) AS entering_run""",
            f"last(last_ns, true) {earlier} AS ns_before",
            f"lag(tail_positions) {order}) AS positions_before",
            f"lag(tail_velocities) {order}) AS velocities_before",
        )
        .selectExpr(
            "*",
            "entering_run + lead_run AS border_run",
            "first_ns - ns_before AS border_gap",
            f"{squared_changes('head_velocities', 'velocities_before')} AS border_sq",
            f"{compared('head_velocities', 'velocities_before')} AS border_pairs",
            f"{jumps('head_positions', 'positions_before')} AS border_jumps",
        )
    )
    aggregates = [
        "sum(n_frames) AS n_frames",
        "sum(n_values) AS n_values",
        "sum(n_null) AS n_null",
        "cast(max(greatest(max_run, border_run)) AS bigint) AS max_null_run",
        "sum(n_stamps) AS n_stamps",
        "max(greatest(max_gap_ns, border_gap)) AS max_gap_ns",
        f"sum(n_bad_gaps + CASE WHEN {border_gap} THEN 1 ELSE 0 END) AS n_bad_gaps",
        "min_by(first_ns, CASE WHEN first_ns IS NOT NULL THEN nth END) AS first_ns",
        "max_by(last_ns, CASE WHEN last_ns IS NOT NULL THEN nth END) AS last_ns",
        "sum(n_pairs + border_pairs) AS n_pairs",
        f"sum({arrays.exact_sum(['sum_sq', 'border_sq'])}) AS sum_sq",
        "sum(n_checked) AS n_checked",
        "sum(n_hard) AS n_hard",
        "sum(n_jumps + border_jumps) AS n_jumps",
    ]
    merged = linked.groupBy("episode_id").agg(*[F.expr(a) for a in aggregates])
    # The gaps telescope, so their mean needs only the two end stamps.
    return merged.selectExpr(
        "episode_id",
        "n_frames",
        "n_values",
        "n_null",
        "max_null_run",
        "n_stamps",
        "max_gap_ns",
        "n_bad_gaps",
        "(last_ns - first_ns) / nullif(n_stamps - 1, 0) AS mean_gap_ns",
        "n_pairs",
        "sqrt(double(sum_sq) / nullif(n_pairs, 0)) AS velocity_rms",
        "n_checked",
        "n_hard",
        "n_jumps",
    )


def frame_stats(frames: DataFrame) -> DataFrame:
    """All statistics the scorer needs, one row per episode with frames."""
    return merge_chunks(chunk_summaries(frame_measures(frames)))


def frame_gaps(frames: DataFrame) -> DataFrame:
    """Gap to the previous non-null timestamp, one row per gap."""
    stamped = (
        with_chunk(frames)
        .where("timestamp_ns IS NOT NULL")
        .select("episode_id", "chunk", "frame_index", "timestamp_ns")
    )
    return (
        neighbours(stamped, ["timestamp_ns"], "episode_id", "frame_index")
        .selectExpr("episode_id", "frame_index", "timestamp_ns - prev_timestamp_ns AS gap_ns")
        .where("gap_ns IS NOT NULL")
    )


def finite_diff_velocity(frames: DataFrame, interval_s: float = 0.005) -> DataFrame:
    """Velocities from positions: central inside, one-sided at both ends."""
    placed = neighbours(
        with_chunk(frames).select("episode_id", "chunk", "frame_index", "positions"),
        ["positions"],
        "episode_id",
        "frame_index",
    )
    return placed.selectExpr(
        "episode_id",
        "frame_index",
        "coalesce(prev_positions, positions) AS low",
        "coalesce(next_positions, positions) AS high",
        f"""nullif(int(prev_positions IS NOT NULL) + int(next_positions IS NOT NULL), 0)
            * {number(interval_s)} AS span_s""",
    ).selectExpr(
        "episode_id",
        "frame_index",
        "zip_with(high, low, (b, a) -> (b - a) / span_s) AS velocities",
    )


def last_complete_phase(phases: DataFrame) -> DataFrame:
    """Whether an episode has a ``complete`` event and the last one's confidence.

    Plain aggregates: Spark combines them on the map side, so a hot episode
    sends one row per map task.
    """
    return phases.groupBy("episode_id").agg(
        F.expr("coalesce(bool_or(phase = 'complete'), false) AS has_complete"),
        F.expr(
            "max_by(confidence, CASE WHEN phase = 'complete' THEN event_index END) AS confidence"
        ),
    )
