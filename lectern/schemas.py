"""Explicit schemas of documents and records, as DDL, so that importing them needs no session; nothing is inferred."""

from __future__ import annotations

TRANSCRIPT = (
    "video_id string, source_audio string, language string, language_probability double, duration double, "
    "model struct<size:string,device:string,compute_type:string>, "
    "segments array<struct<id:int,start:double,end:double,text:string,words:array<struct<start:double,end:double,word:string,probability:double>>>>, "
    "text string, transcribed_at string"
)
DIARIZED = (
    "video_id string, source_audio string, duration double, speakers map<string,struct<total_seconds:double,turn_count:int>>, "
    "target_speaker string, target_speaker_strategy string, turns array<struct<speaker:string,start:double,end:double>>, "
    "target_speaker_segments array<struct<id:int,start:double,end:double,text:string>>, target_speaker_text string, diarized_at string"
)
METADATA = (
    "id string, title string, description string, upload_date string, duration double, duration_string string, channel string, "
    "channel_id string, channel_url string, uploader string, uploader_id string, uploader_url string, tags array<string>, "
    "categories array<string>, view_count bigint, like_count bigint, comment_count bigint, thumbnail string, width int, height int, "
    "fps double, resolution string, ext string, language string, availability string, age_limit int, was_live boolean, "
    "live_status string, url string, downloaded_at string"
)
LISTING = "position int, id string, title string, webpage_url string, url string"
