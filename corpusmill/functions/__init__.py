"""Column-level functions (expressions), usable inside any select."""

from .text import (content_hash, decode_lenient, is_blank, nfc, nfkc, normalize_text,
                   py_rstrip, py_strip, redact_email, redact_phone, redact_pii, sft_text,
                   split_lines, split_words, word_count)

__all__ = ["content_hash", "decode_lenient", "is_blank", "nfc", "nfkc", "normalize_text",
           "py_rstrip", "py_strip", "redact_email", "redact_phone", "redact_pii", "sft_text",
           "split_lines", "split_words", "word_count"]
