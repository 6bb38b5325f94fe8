"""freshet.plans"""
