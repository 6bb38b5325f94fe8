"""freshet.operators"""
