"""Words, names and numbers that results depend on."""

# Words that carry no content.
STOPWORDS = [
    "a", "about", "above", "after", "again", "against", "all", "also", "although", "am", "an", "and", "any", "are",
    "as", "at", "be", "because", "been", "before", "being", "below", "between", "both", "but", "by", "can", "could",
    "did", "do", "does", "doing", "during", "each", "even", "few", "for", "from", "further", "had", "has", "have",
    "having", "he", "her", "here", "hers", "him", "his", "how", "if", "in", "into", "is", "it", "its", "itself",
    "may", "more", "most", "not", "of", "on", "once", "only", "or", "other", "our", "out", "over", "own", "same",
    "she", "should", "so", "some", "such", "than", "that", "the", "their", "theirs", "them", "then", "there",
    "these", "they", "this", "those", "through", "to", "too", "under", "until", "up", "very", "was", "we", "were",
    "what", "when", "where", "which", "while", "who", "whom", "why", "will", "with", "would",
]

# Capitalised words that are no names when they stand alone.
NO_NAMES = [
    "A", "An", "And", "As", "At", "Although", "Because", "But", "Choice", "Choices", "Comprehension", "Do", "Each",
    "Every", "For", "GRE", "If", "In", "It", "On", "Passage", "Question", "Reading", "Reasoning", "Seed",
    "Sentence", "Some", "The", "This", "Verbal", "What", "Which", "While",
]

# Words that may stand inside a name.
NAME_JOINERS = ["of", "and", "the", "for", "in", "on"]

# Kinds of questions and their subtypes.
QUESTION_TYPES = ["text_completion", "sentence_equivalence", "reading_comprehension", "logical_reasoning"]
REASONING_SUBTYPES = [
    "strengthen", "weaken", "necessary_assumption", "sufficient_assumption", "flaw", "method_of_reasoning",
    "parallel_reasoning", "parallel_flaw", "inference", "principle", "disagreement", "resolve_explain",
]
PASSAGE_SUBTYPES = ["single_passage", "comparative_passages"]

# Weights of the similarity components, in the order lexical, phrase, choices, entities, structure.
WEIGHTS = {"lexical": 0.35, "phrase": 0.20, "choice": 0.20, "entity": 0.15, "structure": 0.10}

# Defaults of the gates.
NOVELTY_THRESHOLD = 75.0
LEAST_JUDGE_SCORE = 4.0
MOST_DATASET_ACCURACY = 0.85
NEAR_COPY_RATIO = 0.92
NEAR_COPY_TOKENS = 0.90

# Keys that would give an item's answer away.
ANSWER_KEYS = ["answer", "correct_answer", "correct_labels", "explanation", "judge", "solver_results", "solver_accuracy"]
GROUP_ANSWER_KEYS = ["correct_labels", "explanation"]
