"""Schemas of the stored tables; readers don't infer."""

from __future__ import annotations

KEYFRAMES = "id long, keyframe_id string, video_id string, shot_id string, shot_index int, n int, frame_idx long, pts_time double, fps double, keyframe_path string"
SHOTS = "video_id string, shot_id string, shot_index int, start_frame long, end_frame long, start_time double, end_time double, duration double, fps double, n_keyframes int, keyframes array<struct<frame_idx: bigint, pts_time: double, keyframe_path: string>>, id long"
EVENTS = (
    "video_id string, scene_id int, shot_index int, event_ord int, ord_in_shot int, start_frame long, end_frame long, anchor_frame long, start_time double, end_time double, anchor_time double, fps double, duration double, "
    "boundary_score double, motion string, mag_mean double, action string, keyframe_frames array<bigint>, caption_level string, id long, rep_frame long, rep_keyframe_id string"
)
FRAME_MAP = "n int, pts_time double, fps double, frame_idx long"
KEYFRAME_META = "video_id string, keyframe_id string, shot_id string, frame_idx long, fps double, pts_time double, keyframe_path string"
SHOT_CAPTIONS = "shot_index int, caption string"
QUERIES = "query_id string, query string, distinct int, note string, source string"
TRUTH = (
    "meta map<string, string>, samples array<struct<query_id: string, type: string, query: string, source: string, gt_video: string, gt_frame: bigint, gt_ranges: map<string, array<bigint>>, keyframe_n: int, keyframe_file: string, "
    "pts_time: double, fps: double, n_keyframes: int, video_path: string, distinct: int, distinct_note: string, needs_review: boolean>>"
)
#: Extensions of videos.
VIDEOS = ("mp4", "mkv", "avi", "mov", "webm")
