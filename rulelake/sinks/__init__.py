"""rulelake.sinks"""
