"""Ready compositions of operators for whole datasets.

A plan takes the landed rows and the target's rows and returns what is to be
written.  It is lazy, so the caller decides on sink and trigger.
"""
