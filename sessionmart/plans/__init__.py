"""The layered models (staging -> intermediate -> marts), reports and the check suite.

Each model is a plain ``DataFrame -> DataFrame`` function; composing them builds
one logical plan that Catalyst optimises as a whole.
"""
