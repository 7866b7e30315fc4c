"""Fixed values that results depend on. Keep them verbatim and in order."""

# --- fixed values: cleaning rules, applied in this order, each match -> one space.
# W = word characters, S = white space as Python's Unicode-aware regex sees it.
_W = r"\p{L}\p{N}_"
_S = r"\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}"
CLEANING_RULES = [
    r"<[^\n]*>",  # 1: first '<' to last '>' of a line
    rf"/[^{_S}]+",  # 2: path-like text up to white space
    rf"[a-zA-Z0-9]+_+[^{_S}]+",  # 3: word with underscore up to white space
    r"[a-zA-Z_.|:;-]*\p{Nd}[\p{Nd}a-zA-Z_.|:;-]*",  # 4: any run holding a digit
    rf"[^{_W}{_S}.-]",  # 5: anything but word, space, dot, hyphen
    r" +",  # 6: runs of spaces
]

# --- fixed values: token markers
SPACER = "▁"  # word-break token
PLACEHOLDER = "｟*｠"  # placeholder token of the tokenizer
WILDCARD = "(.*?)"  # placeholder written into patterns
GARBAGE_TOKEN = "[ * ]"

# --- fixed values: a pattern from the first '(' to the ')' run closing the last '('
COLLAPSE_RE = r"\(([^\n]*?)\)+[\S\s]*\(([^\n]*?)\)+"

# --- fixed values: type and version of the published envelope
ENVELOPE_TYPE = "training_document"
ENVELOPE_VERSION = "997"

# --- fixed values: ASCII punctuation (Python's string.punctuation), in order
PUNCTUATION = list("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")

# --- fixed values: English stop words (the common NLTK list, 179 words)
ENGLISH_STOP_WORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours
yourself yourselves he him his himself she she's her hers herself it it's its
itself they them their theirs themselves what which who whom this that that'll
these those am is are was were be been being have has had having do does did
doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down in
out on off over under again further then once here there when where why how all
any both each few more most other some such no nor not only own same so than too
very s t can will just don don't should should've now d ll m o re ve y ain aren
aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven
haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't
shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split()

# Stop list of token cleaning: stop words + punctuation + two quote tokens + spacer.
TOKEN_STOP_LIST = ENGLISH_STOP_WORDS + PUNCTUATION + ["``", "''", SPACER]

# --- fixed values: default key-phrase stop list (short web-search stop list)
PHRASE_STOP_WORDS = """
I a about an are as at be by com de en for from how in is it la of on or that the
this to was what when where who will with und the www
""".split()

# Sentence delimiters and word splitting used for key phrases.
PHRASE_SENTENCE_SPLIT = r"[\[\]\n.!?,;:\t\-\"()’‘']"
