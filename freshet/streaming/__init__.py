"""freshet.streaming"""
