from quarry.functions.text import (  # noqa: F401
    bigram_pairs,
    classify_token,
    drop_last_component,
    first_char_bucket,
    first_char_class,
    java_split,
    lower_word_tokens,
    space_tokens,
    strict_int,
    strict_long,
    text_lines,
    tokenizer_tokens,
    whitespace_words,
)
