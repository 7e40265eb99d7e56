"""No stream operators: the workload is batch only.

The row-local operators (``functions`` and the horizontal panel statistics) are plain column
expressions, so they also run unchanged on a ``readStream`` DataFrame.
"""
