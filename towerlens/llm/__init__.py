"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage.  Each module holds one
operator with a general interface; ``queries`` applies them to the
``documents`` table and derives the digest columns of the registered queries.

Identifiers are integers: operators that move ids between tasks (all but exact
dedup and the quality classifier) cast them to long, so text that is no number
is null or an error, as the session's ANSI mode says; give such rows a number
first.  A text longer than a slice is a slice of its own: splitting and hashing
it takes some twenty bytes a byte of text in its task.
"""
