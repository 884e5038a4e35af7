"""Operators for preparing language-model training data at corpus scale.

Nothing outside this folder imports it.  Executors need the package on their
path (``--py-files`` or an installed wheel), as with any Python worker code.
"""
