"""Fixed schemas of the data sets, so that nothing is inferred when files are read."""

from __future__ import annotations

WORD = "struct<speaker:string,word:string,start:double,end:double>"
EVENT = (
    "struct<timestamp_ms:bigint,conversation_context:string,prediction:string,total_word_count:int,trigger_word:string,"
    "recent_words:string,current_spoken_ratio:double,channel:int,hint:string>"
)
#: Keys of an event record, in the order in which they are written.
EVENT_KEYS = ["timestamp_ms", "conversation_context", "prediction", "total_word_count", "trigger_word", "recent_words", "current_spoken_ratio", "channel", "hint"]
#: Columns of packed events per speaker.
PACKED = ["event_frame_pos", "event_ratio", "event_skip_forbid", "pred_values", "pred_offsets", "hint_values", "hint_offsets"]
