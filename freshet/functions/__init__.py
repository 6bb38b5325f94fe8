"""freshet.functions"""
