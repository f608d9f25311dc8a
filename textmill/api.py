"""The public cleaner API, as column functions.

``process_books3(col)`` etc. map a text column to an ``ARRAY<STRING>`` column of
paragraphs; ``process_jsonl(col, cleaner)`` wraps any cleaner between JSON
decoding and encoding; ``naive_sentence_split(col, max_len)`` packs sentences.
"""

from textmill.functions.segment import sentence_pack as naive_sentence_split
from textmill.operators.profiles import clean_books3 as process_books3
from textmill.operators.profiles import clean_gutenberg as process_gutenberg
from textmill.operators.profiles import clean_webcrawl as process_webcrawls
from textmill.operators.profiles import clean_wiki as process_wiki
from textmill.operators.profiles import register_profile
from textmill.sources.io import process_jsonl

__all__ = ["process_books3", "process_gutenberg", "process_jsonl", "process_webcrawls", "process_wiki",
           "naive_sentence_split", "register_profile"]
