"""The closed word classes of English, as grammars list them."""

from __future__ import annotations

ARTICLES = ("a", "an", "the")
DEMONSTRATIVES = ("this", "that", "these", "those")
SUBJECTS = ("i", "you", "he", "she", "it", "we", "they")
OBJECTS = ("me", "him", "her", "us", "them")
POSSESSIVES = ("my", "your", "his", "her", "its", "our", "their")
REFLEXIVES = ("myself", "yourself", "himself", "herself", "itself", "oneself", "ourselves", "yourselves", "themselves")
QUANTIFIERS = ("all", "any", "both", "each", "every", "few", "many", "much", "no", "some", "such")
QUESTIONS = ("how", "what", "when", "where", "which", "who", "whose", "why")
COORDINATORS = ("and", "but", "nor", "or", "so", "yet")
SUBORDINATORS = ("although", "as", "because", "if", "since", "than", "though", "unless", "until", "while")
MODALS = ("can", "could", "may", "might", "must", "shall", "should", "will", "would")
BE = ("be", "am", "is", "are", "was", "were", "been", "being")
HAVE = ("have", "has", "had", "having")
DO = ("do", "does", "did", "doing", "done")
PREPOSITIONS = ("about", "above", "across", "after", "against", "along", "among", "around", "at", "before", "behind", "below", "beside", "between", "beyond", "by", "during", "for", "from", "in", "into", "like", "near", "of", "off", "on", "onto", "out", "over", "past", "round", "through", "to", "toward", "towards", "under", "up", "upon", "via", "with", "within", "without")
#: Adverbs that make phrasal verbs.
PARTICLES = ("about", "across", "ahead", "along", "apart", "around", "aside", "away", "back", "by", "down", "forth", "forward", "in", "off", "on", "out", "over", "past", "round", "through", "together", "under", "up")

PRONOUNS = tuple(dict.fromkeys((*SUBJECTS, *OBJECTS, *POSSESSIVES, *DEMONSTRATIVES)))
AUXILIARIES = (*BE, *HAVE, *DO, *MODALS)
FUNCTION_WORDS = tuple(dict.fromkeys((*ARTICLES, *PRONOUNS, *REFLEXIVES, *QUANTIFIERS, *QUESTIONS, *COORDINATORS, *SUBORDINATORS, *AUXILIARIES, *PREPOSITIONS, *PARTICLES, "not", "there", "here")))
