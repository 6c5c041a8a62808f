"""Fixed schemas of the record sets; readers apply them, so nothing is inferred."""

CHAPTER = "book_id string, speaker_id string, chapter_id string, src_path string, asr_wav string, master_wav string, codec string, `order` int, src_sample_rate int, sample_rate_asr int, sample_rate_master int, duration double"
SENTENCE = "book_id string, sent_id string, `order` int, text string, normalized string, tokens array<string>"
WORDS = "array<struct<start:double,end:double,word:string,prob:double>>"
TRANSCRIPT = f"{CHAPTER}, asr_text string, words {WORDS}"
SEGMENT = "book_id string, chapter_id string, seg_id string, text string, normalized string, start double, end double, score double, matched_words array<string>"
CLIP = "book_id string, speaker_id string, chapter_id string, seg_id string, clip_id string, wav string, text string, normalized string, start double, end double, duration double, align_score double"
CHECKED = f"{CLIP}, peak double, silence_ratio double, snr_db double, edge_lead_ms long, edge_tail_ms long, cer double, asr_text string, flags array<string>, status string, verdict string"
HEARD = "book_id string, clip_id string, cer double, asr_text string"
VERDICT = "clip_id string, verdict string, flags string"
FLAGGED = "clip_id status flags duration snr_db silence_ratio cer edge_lead_ms edge_tail_ms text wav".split()
