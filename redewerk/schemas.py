"""Explicit schemas of the files and tables; nothing is inferred."""

from __future__ import annotations

MESSAGE = "struct<role: string, content: string>"
RECORD = f"messages array<{MESSAGE}>, meta struct<stem: string, top: int, strategy: string, src_tokens: int, tgt_tokens: int, seq_tokens: int>"
MANIFEST = "example string, stem string, source string, tops int, speakers int, invented_speakers int, transcript_words int, gold_words int, split_note string"
REJECTS = "stem string, top string, reason string, seq_tokens string, disposition string"
SIGNED = "struct<size: bigint, mtime: bigint, sha256: string>"
LEDGER = f"stem string, committee string, wp string, sitting int, raw_dir string, pdf_src string, audio_src array<string>, signature struct<pdf: {SIGNED}, audio: array<{SIGNED}>>, first_seen string, last_seen string"
INGEST_REPORT = "stem string, committee string, wp string, sitting string, n_pdf bigint, n_audio bigint, flags string, state string, pdf_src string, audio_src string"
ASR_SEGMENT = "session string, ord int, start double, end double, text string"
DIARISED = "session string, ord int, start double, end double, speaker string"
FILE = "path string, length bigint, modificationTime timestamp"
LLM_ANSWERS = "prompt_hash string, response string"
