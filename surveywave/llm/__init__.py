"""Operators for preparing training data at corpus scale.

One module per operator; ``queries`` applies each to its whole table and
``corpus_pipeline`` (repository top) chains five of them.  Nothing outside this
package imports it.
"""
