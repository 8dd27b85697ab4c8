"""Text functions: tokens, speech metrics, repetition, names of languages, model output.

All are Column to Column and run in the JVM, but for the counts of repeated
words, which are Arrow kernels over whole batches.  A null text counts as an empty one
unless a function says otherwise.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space at both ends, in the Unicode sense (``trim`` knows only U+0020).
_OUTER = r"(?U)^\s+|(?<!\s)\s+$"

# Fixed values of the curation rules.
MIN_WPM = {"en": 70.0, "ms": 70.0, "zh": 110.0, "ta": 50.0}
DEFAULT_MIN_WPM = 70.0
STUTTER_LIMIT = {"zh": 0.50}
DEFAULT_STUTTER_LIMIT = 0.40
MIN_SPEECH_RATIO = 0.50
MAX_REDUNDANCY = 0.4
WORDS_PER_SECOND = 2.3
TOKEN_PATTERNS = {"zh": r"[一-鿿]", "ta": r"[஀-௿]+|[a-zA-Z0-9]+"}
DEFAULT_TOKEN_PATTERN = r"[a-zA-Z0-9]+"
SPEAKER_TAGS = ["<Speaker1>:", "<Speaker2>:"]
LANGUAGE_ALIASES = {"ml": "ms", "cn": "zh"}
ASR_TAG = "<asr_text>"
SUPPORTED_LANGUAGES = [
    "Chinese", "English", "Cantonese", "Arabic", "German", "French", "Spanish", "Portuguese", "Indonesian", "Italian",
    "Korean", "Russian", "Thai", "Vietnamese", "Japanese", "Turkish", "Hindi", "Malay", "Dutch", "Swedish", "Danish",
    "Finnish", "Polish", "Czech", "Filipino", "Persian", "Greek", "Romanian", "Hungarian", "Macedonian",
]


def by_language(lang: Column, table: dict, default) -> Column:
    """A value looked up by language, as a CASE that folds into the plan."""
    out = None
    for key, value in table.items():
        out = F.when(lang == key, F.lit(value)) if out is None else out.when(lang == key, F.lit(value))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def strip(text: Column) -> Column:
    """Without outer white space of any script."""
    return F.regexp_replace(text, _OUTER, "")


def canonical_code(lang: Column) -> Column:
    """Language code in lower case, with aliases resolved."""
    return F.coalesce(*[F.when(F.lower(lang) == a, F.lit(c)) for a, c in LANGUAGE_ALIASES.items()], F.lower(lang))


def strip_speaker_tags(text: Column) -> Column:
    """Without the two known speaker tags, then without outer white space; other tags stay."""
    out = F.coalesce(text, F.lit(""))
    for tag in SPEAKER_TAGS:
        out = F.replace(out, F.lit(tag), F.lit(""))
    return strip(out)


def language_tokens(text: Column, lang: Column) -> Column:
    """Lower-case tokens: single characters for zh, Tamil or Latin runs for ta, Latin runs for the rest."""
    body = strip_speaker_tags(text)
    find = lambda p: F.regexp_extract_all(body, F.lit(p), F.lit(0))
    chosen = F.when(lang == "zh", find(TOKEN_PATTERNS["zh"])).when(lang == "ta", find(TOKEN_PATTERNS["ta"])).otherwise(find(DEFAULT_TOKEN_PATTERN))
    return F.transform(chosen, F.lower)


def safe_duration(duration: Column) -> Column:
    """Duration for divisions: never below a millisecond."""
    return F.greatest(duration, F.lit(0.001))


def words_per_minute(word_count: Column, duration: Column) -> Column:
    return word_count / safe_duration(duration) * 60


def estimated_talk_time(word_count: Column, duration: Column) -> Column:
    """Talk time guessed from the number of words, at most the duration."""
    return F.least(word_count / F.lit(WORDS_PER_SECOND), duration)


def word_spans(word_count: Column, duration: Column) -> Column:
    """Equal spans of the words over the guessed talk time, centred in the recording; empty without words."""
    talk = estimated_talk_time(word_count, duration)
    start = (duration - talk) / 2
    each = talk / word_count
    span = lambda i: F.struct((start + (i - 1) * each).alias("start_time"), (start + i * each).alias("end_time"))
    return F.when(word_count > 0, F.transform(F.sequence(F.lit(1), word_count.cast("int")), span)).otherwise(
        F.array().cast("array<struct<start_time:double,end_time:double>>")
    )


def span_total(spans: Column) -> Column:
    """Sum of span lengths, added from left to right."""
    return F.aggregate(spans, F.lit(0.0), lambda acc, s: acc + (s["end_time"] - s["start_time"]))


def characters_per_minute(text: Column, duration: Column) -> Column:
    """Code points per minute; null where the duration is not above 0."""
    return F.when(duration > 0, F.length(text) / duration * 60)


def _codes(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of a batch as numbers in one row, the list that each is of, and the lists' lengths."""
    sizes = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.list_flatten(words)
    codes = pc.fill_null(flat.dictionary_encode().indices, -1) if len(flat) else pa.array([], pa.int32())
    return codes.to_numpy(zero_copy_only=False).astype(np.int64), np.repeat(np.arange(len(sizes)), sizes), sizes


def stutter_counts(words: pa.Array, window: int, times: int) -> pa.Array:
    """Number of windows of each list in which some word stands ``times`` or more."""
    codes, row, sizes = _codes(words)
    if len(codes) < window:
        return pa.array(np.zeros(len(sizes), np.int32))
    frames = np.lib.stride_tricks.sliding_window_view(codes, window)
    whole = row[: len(frames)] == row[window - 1 :]
    hit = np.zeros(len(frames), bool)
    # A word that fills `times` of the window's places is among its first window - times + 1.
    for k in range(window - times + 1):
        hit |= (frames == frames[:, k : k + 1]).sum(axis=1) >= times
    return pa.array(np.bincount(row[: len(frames)][hit & whole], minlength=len(sizes)).astype(np.int32))


def distinct_ngrams(words: pa.Array, n: int) -> pa.Array:
    """Number of different runs of ``n`` words of each list."""
    codes, row, sizes = _codes(words)
    if len(codes) < n:
        return pa.array(np.zeros(len(sizes), np.int32))
    last, several = len(codes) - n + 1, int(codes.max()) + 2
    gram = codes[:last] + 1
    for k in range(1, n):
        gram = np.unique(gram * several + codes[k : last + k] + 1, return_inverse=True)[1]
    whole = row[:last] == row[n - 1 :]
    kinds = int(gram.max()) + 1
    once = np.unique(row[:last][whole] * kinds + gram[whole])
    return pa.array(np.bincount(once // kinds, minlength=len(sizes)).astype(np.int32))


def _counts(kernel, *args: int):
    """An Arrow function of a column of word lists; one batch at a time, without a loop over rows."""

    def run(words: pa.Array) -> pa.Array:
        return kernel(words, *args)

    return F.arrow_udf(run, "int")


def word_repetition(words: Column, window: int = 5, times: int = 3) -> Column:
    """Share of sliding windows that hold some word ``times`` or more, to four places; 0 for fewer words than a window."""
    n = F.size(words)
    return F.when(n >= window, F.round(_counts(stutter_counts, window, times)(words) / (n - (window - 1)), 4)).otherwise(F.lit(0.0))


def ngrams(words: Column, n: int = 3) -> Column:
    """All runs of n words, joined by blanks; empty for fewer words."""
    gram = lambda i: F.array_join(F.slice(words, i, n), " ")
    return F.when(F.size(words) >= n, F.transform(F.sequence(F.lit(1), F.size(words) - (n - 1)), gram)).otherwise(F.array().cast("array<string>"))


def redundancy(words: Column, n: int = 3) -> Column:
    """Share of n-grams that repeat another one, to four places; 0 for fewer words than n."""
    total = F.size(words) - (n - 1)
    return F.when(F.size(words) >= n, F.round((total - _counts(distinct_ngrams, n)(words)) / total, 4)).otherwise(F.lit(0.0))


def quality_tier(wpm: Column, speech_ratio: Column, repetition: Column, redundant: Column, lang: Column) -> Column:
    """``discard`` or ``neutral`` by the ordered rules on speed, speech, stutter and redundancy."""
    low = (
        (wpm < by_language(lang, MIN_WPM, DEFAULT_MIN_WPM))
        | (speech_ratio < MIN_SPEECH_RATIO)
        | (repetition > by_language(lang, STUTTER_LIMIT, DEFAULT_STUTTER_LIMIT))
        | (redundant > MAX_REDUNDANCY)
    )
    return F.when(low, "discard").otherwise("neutral")


def discard_reason(wpm: Column, speech_ratio: Column, repetition: Column, redundant: Column, lang: Column) -> Column:
    """The first rule that discards a row; null for a row that is kept."""
    return (
        F.when(wpm < by_language(lang, MIN_WPM, DEFAULT_MIN_WPM), "slow")
        .when(speech_ratio < MIN_SPEECH_RATIO, "little_speech")
        .when(repetition > by_language(lang, STUTTER_LIMIT, DEFAULT_STUTTER_LIMIT), "stutter")
        .when(redundant > MAX_REDUNDANCY, "redundant")
    )


def failed_transcript(text: Column, error: Column) -> Column:
    """True for a row with an error, or without text."""
    return F.coalesce(error != "", F.lit(False)) | F.coalesce(text == "", F.lit(True))


def whitespace_words(text: Column, sentinel: bool = False) -> Column:
    """Words between white space; with a closing empty word where asked for."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"(?U)\s+"), lambda w: w != "")
    return F.array_append(words, F.lit("")) if sentinel else words


def collapse_repetitions(text: Column, threshold: int = 20, longest: int = 20) -> Column:
    """One copy of a character repeated more than ``threshold`` times, and of a short pattern repeated ``threshold`` times or more."""
    once = F.regexp_replace(text, rf"(?s)(.)\1{{{threshold},}}", "$1")
    return F.regexp_replace(once, rf"(?s)(?=.{{{2 * threshold}}})(.{{1,{longest}}}?)\1{{{threshold - 1},}}", "$1")


def language_name(name: Column) -> Column:
    """First letter upper, the rest lower; null for a blank name."""
    plain = strip(name)
    return F.when(plain != "", F.concat(F.upper(F.left(plain, F.lit(1))), F.lower(F.substr(plain, F.lit(2)))))


def is_supported_language(name: Column) -> Column:
    return F.coalesce(language_name(name).isin(SUPPORTED_LANGUAGES), F.lit(False))


def title_display(name: Column) -> Column:
    """Underscores to blanks, each word with a capital."""
    return F.array_join(F.transform(F.split(F.replace(name, F.lit("_"), F.lit(" ")), " "), lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.substr(w, F.lit(2)))), " ")


def parse_asr_output(raw: Column, forced: Column | None = None) -> Column:
    """Struct of ``language`` and ``text`` from a recogniser's raw answer.

    A forced language makes the whole answer text.  Without the tag everything
    is text and the language is empty; ``language none`` before it means
    silence or an unknown language; null and blank answers give two empty ones.
    """
    body = collapse_repetitions(strip(F.coalesce(raw, F.lit(""))))
    at = F.instr(body, ASR_TAG)
    meta = F.when(at > 0, F.substring_index(body, ASR_TAG, 1)).otherwise(F.lit(""))
    after = strip(F.substr(body, at + len(ASR_TAG)))
    # The first line of the part before the tag that names a language, even an empty one.
    named = strip(F.regexp_extract(meta, r"(?im)^\s*language (.*)$", 1))
    silent = F.lower(meta).contains("language none")
    language = F.when(at == 0, F.lit("")).when(silent, F.lit("")).otherwise(F.coalesce(language_name(named), F.lit("")))
    text = F.when(at == 0, strip(body)).otherwise(after)
    if forced is None:
        return F.struct(language.alias("language"), text.alias("text"))
    given = F.coalesce(forced, F.lit("")) != ""
    empty = body == ""
    return F.struct(
        F.when(empty, F.lit("")).when(given, forced).otherwise(language).alias("language"),
        F.when(empty, F.lit("")).when(given, body).otherwise(text).alias("text"),
    )


#: CJK ideographs, extensions and compatibility forms.
CJK_RANGES = [
    (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x2A6DF), (0x2A700, 0x2B73F), (0x2B740, 0x2B81F), (0x2B820, 0x2CEAF),
]
CJK_CLASS = "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in CJK_RANGES)


def is_cjk(char: Column) -> Column:
    return char.rlike(f"^[{CJK_CLASS}]$")


def clean_token(token: Column) -> Column:
    """Letters, digits and apostrophes of a token."""
    return F.regexp_replace(token, r"[^\p{L}\p{N}']", "")


def aligner_tokens(text: Column) -> Column:
    """Tokens for alignment: words between blanks, cleaned, each CJK character on its own."""
    cleaned = F.filter(F.transform(whitespace_words(text), clean_token), lambda t: t != "")
    parts = F.transform(cleaned, lambda t: F.regexp_extract_all(t, F.lit(f"[{CJK_CLASS}]|[^{CJK_CLASS}]+"), F.lit(0)))
    return F.flatten(parts)


def chinese_mixed_tokens(text: Column) -> Column:
    """CJK characters and runs of other letters, digits and apostrophes, in order."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(rf"[{CJK_CLASS}]|(?:(?![{CJK_CLASS}])[\p{{L}}\p{{N}}'])+"), F.lit(0))


def aligner_prompt(tokens: Column, audio: str = "<|audio_start|><|audio_pad|><|audio_end|>", stamp: str = "<timestamp>") -> Column:
    """Prompt of the aligner: the audio mark, then every token followed by two time marks."""
    return F.concat(F.lit(audio), F.array_join(F.transform(tokens, lambda t: F.concat(t, F.lit(stamp + stamp))), ""))


def render_prompt(template: str, **values: Column) -> Column:
    """A template with ``{name}`` replaced by columns; a null value becomes an empty one."""
    out = F.lit(template)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(value.cast("string"), F.lit("")))
    return out


def training_prefix(prompt: Column) -> Column:
    """Chat prefix of a fine-tuning row: system prompt, audio placeholder, start of the answer."""
    system = F.coalesce(prompt, F.lit(""))
    return F.concat(F.lit("<|im_start|>system\n"), system, F.lit("<|im_end|>\n<|im_start|>user\n<|audio_start|><|audio_pad|><|audio_end|><|im_end|>\n<|im_start|>assistant\n"))


def expand_placeholder(text: Column, placeholder: str, times: Column) -> Column:
    """The first placeholder repeated; a text without one stays as it is."""
    at = F.instr(text, placeholder)
    return F.when(at > 0, F.concat(F.substr(text, F.lit(1), at - 1), F.repeat(F.lit(placeholder), times), F.substr(text, at + len(placeholder)))).otherwise(text)


def input_kind(value: Column) -> Column:
    """``url``, ``base64`` or ``path`` of an audio reference."""
    url = value.rlike(r"^(?i:https?)://[^/\s]+")
    base64 = value.startswith("data:audio") | (~value.contains("/") & ~value.contains("\\") & (F.length(value) > 256))
    return F.when(url, "url").when(base64, "base64").otherwise("path")


# ---------------------------------------------------------------- ids and paths
def file_stem(path: Column) -> Column:
    """Last part of a path without its extension."""
    return F.regexp_replace(F.substring_index(path, "/", -1), r"(?<=.)\.[^.]*$", "")


def parent_folder(path: Column) -> Column:
    """Name of the folder that a file lies in; empty for none."""
    return F.coalesce(F.get(F.reverse(F.split(path, "/")), F.lit(1)), F.lit(""))


def name_parts(name: Column, lead: int = 3) -> Column:
    """Struct of ``sub_folder`` (the first ``lead`` parts between underscores) and ``id`` (the rest)."""
    parts = F.split(name, "_")
    return F.struct(
        F.array_join(F.slice(parts, 1, lead), "_").alias("sub_folder"),
        F.array_join(F.filter(parts, lambda _, i: i >= lead), "_").alias("id"),
    )


def flat_id(value: Column) -> Column:
    """Slashes to underscores."""
    return F.translate(value, "/", "_")


def drop_id_prefix(raw_id: Column, folder: Column) -> Column:
    """Every ``<folder without _wav>_`` taken out of an id; an empty folder takes out every underscore."""
    prefix = F.concat(F.replace(F.coalesce(folder, F.lit("")), F.lit("_wav"), F.lit("")), F.lit("_"))
    return F.replace(F.coalesce(raw_id, F.lit("")), prefix, F.lit(""))


def leading_label(value: Column) -> Column:
    """Text before the first underscore."""
    return F.substring_index(value, "_", 1)


def first_nonempty(*values: Column) -> Column:
    """The first value that is neither null nor empty; an empty string if none is."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values], F.lit(""))


def generated_id(prefix: str, number: Column) -> Column:
    """A constant prefix and a number."""
    return F.concat(F.lit(prefix + "_"), number.cast("string"))


def first_element(values: Column, fallback: Column) -> Column:
    """The first element of a list; ``fallback`` for a null or empty list and for a null element."""
    return F.coalesce(F.get(values, F.lit(0)), fallback)


def override_map(base: Column, other: Column) -> Column:
    """A map with the entries of another one put over its own; a null map counts as empty."""
    kind = "map<string,string>"
    own, new = F.coalesce(base, F.create_map().cast(kind)), F.coalesce(other, F.create_map().cast(kind))
    return F.map_concat(F.map_filter(own, lambda k, _: ~F.map_contains_key(new, k)), new)


# ---------------------------------------------------------------- merging of chunks
def merge_texts(parts: Column, separator: str = " ") -> Column:
    """Ordered chunk texts joined, empty and null ones left out."""
    return F.array_join(F.filter(parts, lambda x: x.isNotNull() & (x != "")), separator)


def merge_languages(langs: Column) -> Column:
    """Languages in order without empty ones and without neighbours that repeat, joined by commas."""
    kept = F.filter(F.transform(langs, lambda x: strip(F.coalesce(x, F.lit("")))), lambda x: x != "")
    once = F.aggregate(
        kept, F.array().cast("array<string>"), lambda acc, x: F.when((F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1)) == x), acc).otherwise(F.array_append(acc, x))
    )
    return F.array_join(once, ",")


def roll_back_tokens(tokens: Column, drop: int, keep_least: int = 0) -> Column:
    """Without the last ``drop`` tokens, but at least ``keep_least``."""
    return F.slice(tokens, 1, F.greatest(F.size(tokens) - drop, F.lit(keep_least)))
