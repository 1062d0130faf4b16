"""Defaults and fixed values.

Everything in the "fixed values" block must stay equal to the behaviour being
reproduced; change the defaults block freely.
"""

# ---------------------------------------------------------------- defaults
SENTENCE_CAP = 50           # of the optional cap on sentences per article; no cap unless one is asked for
ORACLE_K = 3                # greedy oracle sentences
TOP_K = 3                   # summary sentences
MAX_TOKENS = 4000           # vocabulary size including the two reserved ids
SEQ_LEN = 32                # token ids per sentence
EMB_DIM = 32
DENSE_UNITS = 64
DROPOUT = 0.2
BATCH_SIZE = 256
EPOCHS = 10
PATIENCE = 3
CALIBRATION_SAMPLES = 500
LEARNING_RATE = 1e-3

# ------------------------------------------------------------ fixed values
# Vocabulary reserved entries: id 0 is padding, id 1 is out-of-vocabulary.
PAD_TOKEN = ""
UNK_TOKEN = "[UNK]"
PAD_ID = 0
UNK_ID = 1

# The 29 characters Python's str.strip() removes (str.isspace()), as a set for trim().
PY_WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
                 "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
                 "\u2028\u2029\u202f\u205f\u3000")
# The same set as a regex class: ASCII controls
# \t \n \v \f \r, the separators \x1c-\x1f, NEL, and every Z* code point.
WS_CLASS = r"[\t\n\x0B\f\r\x1C-\x1F\x{85}\p{Z}]"
# Words whose period never ends a sentence, and those whose period ends one only where no
# lower-case letter or digit follows; the latter also holds for dotted letters ("p.m.", "U.S.").
TITLES = ("Mr", "Mrs", "Ms", "Dr", "Prof", "Gen", "Col", "Capt", "Lt", "Sgt", "Rev", "Hon", "Sen", "Rep", "Gov", "St",
          "Mt", "vs")
ABBREVIATIONS = ("etc", "Inc", "Corp", "Co", "Ltd", "Jr", "Sr", "approx", "dept", "est", "al", "No", "Jan", "Feb", "Mar",
                 "Apr", "Jun", "Jul", "Aug", "Sep", "Sept", "Oct", "Nov", "Dec")
# Whitespace used to split standardized text into tokens (ASCII only).
ASCII_WS_CLASS = r"[ \t\n\x0B\f\r]"
# Sentence end: terminal punctuation run, optional closing quotes/brackets.
SENTENCE_END = r"""([.!?]+["')\]]*)"""
# Punctuation deleted by the default text standardization (32 ASCII characters).
PUNCT_CHARS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'"
PUNCT_CLASS = r"""[!"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~']"""
# ASCII whitespace that separates tokens of the standardized text.
ASCII_WS_CHARS = " \t\n\x0b\x0c\r"
UPPER_ASCII = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER_ASCII = "abcdefghijklmnopqrstuvwxyz"
# ROUGE tokenizer: anything but lower-case ASCII letters and digits separates.
ROUGE_NON_ALNUM = r"[^a-z0-9]+"

# Output tensor of a sigmoid in a full-integer int8 model.
SIGMOID_OUT_SCALE = 1.0 / 256.0
SIGMOID_OUT_ZERO_POINT = -128

# Adam defaults of the training framework the scorer mirrors.
ADAM_BETA1 = 0.9
ADAM_BETA2 = 0.999
ADAM_EPSILON = 1e-7

# Split names.
SPLITS = ("train", "validation", "test")
