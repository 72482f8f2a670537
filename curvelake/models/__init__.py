"""Fits, likelihoods, predictive draws, small nets and invertible-map densities.

A fit makes one or a few passes over the data as Spark aggregations; only moments or
gradients of a size set by the model come to the driver.
"""
