"""Hand-made episodes with hand-computed scores."""

from __future__ import annotations

import copy
import json

MS = 1_000_000


def baseline(n: int = 10, spacing_ns: int = 5 * MS) -> dict:
    return {
        "episode_id": "e",
        "robot_id": "robot_001",
        "operator_id": "operator_001",
        "task_type": "pick_place",
        "session_ts": 1,
        "status": "completed",
        "duration_ms": 50.0,
        "task_completed": True,
        "injected_failure": "none",
        "frame_count": n,
        "sensor_frames": [
            {
                "timestamp_ns": i * spacing_ns,
                "joint_positions": [0.0] * 12,
                "joint_velocities": [0.0] * 12,
                "gripper_force": [0.0, 0.0],
                "ee_pose": [0.0] * 7,
                "frame_index": i,
            }
            for i in range(n)
        ],
        "camera_frames": [],
        "phase_events": [
            {"timestamp_ns": 0, "phase": "approach", "confidence": 0.9},
            {"timestamp_ns": 1, "phase": "complete", "confidence": 1.0},
        ],
    }


def null_frame(frame: dict) -> None:
    frame["joint_positions"] = [None] * 12
    frame["joint_velocities"] = [None] * 12


def build() -> dict[str, tuple[dict, list[float], float, str, list[str]]]:
    """name -> (episode, five dimensions, composite, routing, flags)"""
    cases = {}

    def case(name, episode, dims, composite, routing, *flags):
        episode = copy.deepcopy(episode)
        episode["episode_id"] = name
        cases[name] = (episode, dims, composite, routing, list(flags))

    case("E1", baseline(), [100] * 5, 100, "CERTIFIED")
    case("E2", baseline(0), [0] * 5, 0, "REJECTED", "NO_FRAMES")

    e = baseline()
    for i in (3, 4, 5):
        null_frame(e["sensor_frames"][i])
    case(
        "E3", e, [75, 100, 100, 100, 100], 69.9, "REJECTED",
        "SENSOR_COMPLETENESS:DROPOUT_WINDOW(3 consecutive null frames)",
    )

    e = baseline(100)
    null_frame(e["sensor_frames"][50])
    case(
        "E4", e, [80, 100, 100, 100, 100], 96, "CERTIFIED",
        "SENSOR_COMPLETENESS:SCATTERED_NULLS(1.00%)",
    )

    e = baseline()
    for f in e["sensor_frames"][5:]:
        f["timestamp_ns"] += 95 * MS
    case(
        "E5", e, [100, 50, 100, 100, 100], 69.9, "REJECTED",
        "TEMPORAL_COHERENCE:GAP(100.0ms max, 1 violations)",
    )

    case("E6a", baseline(spacing_ns=6 * MS), [100, 70, 100, 100, 100], 92.5, "CERTIFIED")
    case("E6b", baseline(spacing_ns=5_500_000), [100, 80, 100, 100, 100], 95, "CERTIFIED")
    e = baseline()
    e["sensor_frames"][5]["timestamp_ns"] = None
    case("E6c", e, [100, 75, 100, 100, 100], 93.75, "CERTIFIED")

    def alternating(v):
        e = baseline()
        for i, f in enumerate(e["sensor_frames"]):
            f["joint_velocities"] = [v if i % 2 else 0.0] * 12
        return e

    case(
        "E7a", alternating(3.2), [100, 100, 40, 100, 100], 69.9, "REJECTED",
        "MOTION_SMOOTHNESS:JITTER(RMS=3.200 rad/s, threshold=2.2)",
    )
    case(
        "E7b", alternating(2.5), [100, 100, 68, 100, 100], 92, "CERTIFIED",
        "MOTION_SMOOTHNESS:JITTER(RMS=2.500 rad/s, threshold=2.2)",
    )
    case("E7c", alternating(2.0), [100, 100, 87.27, 100, 100], 96.82, "CERTIFIED")

    e = baseline()
    e["status"] = "aborted"
    case(
        "E8", e, [100, 100, 100, 0, 100], 69.9, "REJECTED",
        "TASK_COMPLETION:ABORTED(status=aborted)",
    )
    e = baseline()
    e["phase_events"] = e["phase_events"][:1]
    case(
        "E9", e, [100, 100, 100, 60, 100], 92, "CERTIFIED",
        "TASK_COMPLETION:MISSING_COMPLETE_PHASE",
    )
    e = baseline()
    e["phase_events"][1]["confidence"] = 0.8
    case("E10a", e, [100, 100, 100, 85, 100], 97, "CERTIFIED")
    e = baseline()
    e["phase_events"] = [
        {"timestamp_ns": 0, "phase": "complete", "confidence": 0.95},
        {"timestamp_ns": 1, "phase": "complete", "confidence": 0.5},
    ]
    case(
        "E10b", e, [100, 100, 100, 70, 100], 94, "CERTIFIED",
        "TASK_COMPLETION:LOW_CONFIDENCE(0.50)",
    )

    e = baseline()
    e["sensor_frames"][4]["joint_positions"][0] = 0.2
    case(
        "E11", e, [100, 100, 100, 100, 75], 69.9, "REJECTED",
        "TRAJECTORY_VALIDITY:ANOMALY(hard=0.00%, jumps=2)",
    )
    e = baseline()
    for f in e["sensor_frames"]:
        f["joint_positions"][7] = 0.85
    case(
        "E12", e, [100, 100, 100, 100, 0], 69.9, "REJECTED",
        "TRAJECTORY_VALIDITY:ANOMALY(hard=8.33%, jumps=0)",
    )
    e = baseline(40)
    for i, f in enumerate(e["sensor_frames"]):
        f["joint_positions"][7] = 0.82 if i == 20 else 0.80
    case("E13", e, [100, 100, 100, 100, 95.83], 99.58, "CERTIFIED")

    case(
        "E14", baseline(1), [100, 0, 50, 100, 100], 62.5, "REJECTED",
        "TEMPORAL_COHERENCE:TOO_FEW_TIMESTAMPS", "MOTION_SMOOTHNESS:NO_VALID_VELOCITIES",
    )
    e = baseline()
    for f in e["sensor_frames"]:
        f["joint_positions"] = f["joint_velocities"] = []
    case(
        "E15", e, [0, 100, 50, 100, 50], 62.5, "REJECTED",
        "SENSOR_COMPLETENESS:NO_READINGS", "MOTION_SMOOTHNESS:NO_VALID_VELOCITIES",
    )
    e = baseline(100)
    for f in e["sensor_frames"][20:73]:
        null_frame(f)
    case(
        "E16", e, [0, 100, 100, 100, 100], 69.9, "REJECTED",
        "SENSOR_COMPLETENESS:DROPOUT_WINDOW(53 consecutive null frames)",
    )
    e = baseline()
    e["sensor_frames"][4]["joint_positions"][0] = None
    for f in e["sensor_frames"][5:]:
        f["joint_positions"][0] = 1.0
    case("E17", e, [100] * 5, 100, "CERTIFIED")
    return cases


def lines() -> list[str]:
    return [json.dumps(episode) for episode, *_ in build().values()]
