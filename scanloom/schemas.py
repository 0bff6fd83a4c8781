"""Schemas of the records that the operators exchange, declared and never inferred."""

from __future__ import annotations

MESSAGES = "bag string, topic string, msg_type string, ts_ns bigint, data binary"

POINTS = "seq string, frame_id bigint, point_idx bigint, x float, y float, z float, intensity float"

SYNC_MAP = (
    "frame_id bigint, timestamp bigint, lidar string, camera1_image string, camera1_intrinsic string, camera2_image string, "
    "camera2_intrinsic string, has_camera1 boolean, has_camera2 boolean, complete_frame boolean"
)

DETECTION = "struct<class_id: int, class_name: string, bbox: array<double>, confidence: double, mask_area: bigint, mask_score: double, camera: string, image_file: string>"

ANNOTATIONS = (
    f"frame_id bigint, timestamp bigint, lidar_file string, camera1_image string, camera2_image string, detections_2d array<{DETECTION}>, "
    "num_points bigint, moving_points bigint, static_points bigint, moving_ratio double"
)

#: Activities are ordered lists of pairs, as the rule that reads them hangs on their order.
ACTIVITIES = "array<struct<key: string, value: double>>"

BOX = f"frame string, cx double, cy double, cz double, l double, w double, h double, rot_z double, actions {ACTIVITIES}, social {ACTIVITIES}"

INTRINSICS = "path string, K array<double>, D array<double>, height int, width int, fx double, fy double, cx double, cy double, error string"
