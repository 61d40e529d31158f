"""Every operator bound to the test tables, with an independent SQL answer.

``registry`` holds the pairs; the modules ``of_*`` fill it.
"""
