"""Wordings of well-known licenses and notices, with the markup that `license_scan` reads."""

# The licenses' own words.
_COPYRIGHT = """<<beginOptional>>Copyright
<<var;name="sign";original="(c)";match="c|©|">> <<var;name="holders";original="year holders";match=".{0,20}">>
<<beginOptional>>All rights reserved.<<endOptional>><<endOptional>>"""

_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of
<<var;name="what";original="this software and associated documentation files";match="this software and associated documentation files|this software and associated documentation|this software">>
(the "Software"), to deal in the Software without restriction, including without limitation the rights to
use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to
permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice
<<beginOptional>>(including the next paragraph)<<endOptional>>
shall be included in all copies or substantial portions of the Software.
<<beginOptional>>THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING
BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.
IN NO EVENT SHALL <<var;name="who";original="THE AUTHORS OR COPYRIGHT HOLDERS";match=".{1,12}">> BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF
OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.<<endOptional>>"""

_ISC_GRANT = """Permission to use, copy, modify, and<<var;name="slash";original="/or";match="or|">> distribute this software
for any purpose with or without fee is hereby granted, provided that the above copyright notice and this
permission notice appear in all copies."""

_BSD_START = """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met:
<<beginOptional>>1<<endOptional>> Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer.
<<beginOptional>>2<<endOptional>> Redistributions in binary form must reproduce the above copyright notice, this list of
conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution."""
_BSD_NAMES = """<<beginOptional>>3<<endOptional>> Neither the name of
<<var;name="holder";original="the copyright holder";match=".{1,12}">> nor the names of
<<var;name="whose";original="its";match="its|the">> contributors may be used to endorse or promote products derived
from this software without specific prior written permission."""
_BSD_END = """THIS SOFTWARE IS PROVIDED BY <<var;name="by";original="THE COPYRIGHT HOLDERS AND CONTRIBUTORS";match=".{1,12}">>
"AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."""

_NOTICE = """<<var;name="how";original="Licensed";match="licensed|released|distributed|available|provided">> under
<<beginOptional>>the terms of<<endOptional>> <<var;name="a";original="the";match="the|a">>"""

_APACHE = """Licensed under the Apache License, Version 2.0
<<beginOptional>>(the "License"); you may not use this file except in compliance with the
License<<endOptional>>"""

_MPL = """This Source Code Form is subject to the terms of the Mozilla Public License,
<<var;name="version";original="v.";match="v|version">> 2.0"""

_UNLICENSE = "This is free and unencumbered software released into the public domain."

_GNU = """GNU {kind} <<beginOptional>>as published by the Free Software Foundation<<endOptional>>
<<beginOptional>>either<<endOptional>> <<var;name="version";original="version";match="version|v">> {version}"""
_LATER = """<<beginOptional>>of the License<<endOptional>> or <<beginOptional>>(at your option)<<endOptional>>
any later version"""
_GNU_LICENSES = (
    ("gpl-2.0", "General Public License", "2"),
    ("gpl-3.0", "General Public License", "3"),
    ("lgpl-2.1", "Lesser General Public License", "2.1"),
    ("lgpl-3.0", "Lesser General Public License", "3"),
    ("agpl-3.0", "Affero General Public License", "3"),
)
_CREATIVE_COMMONS = (
    ("cc-by-4.0", "Attribution 4.0 International"),
    ("cc-by-sa-4.0", "Attribution-ShareAlike 4.0 International"),
    ("cc-by-nc-4.0", "Attribution-NonCommercial 4.0 International"),
)

#: Label and wording of each template.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("mit", f"{_COPYRIGHT} {_MIT_GRANT}"),
    ("mit", f"{_NOTICE} MIT License"),
    ("isc", f"{_COPYRIGHT} {_ISC_GRANT}"),
    ("bsd-2-clause", f"{_COPYRIGHT} {_BSD_START} {_BSD_END}"),
    ("bsd-3-clause", f"{_COPYRIGHT} {_BSD_START} {_BSD_NAMES} <<beginOptional>>{_BSD_END}<<endOptional>>"),
    ("apache-2.0", _APACHE),
    ("mpl-2.0", _MPL),
    ("unlicense", _UNLICENSE),
    *((label, _GNU.format(kind=kind, version=v)) for label, kind, v in _GNU_LICENSES),
    *((f"{label}-or-later", f"{_GNU.format(kind=kind, version=v)} {_LATER}") for label, kind, v in _GNU_LICENSES),
    *((label, f"{_NOTICE} Creative Commons {name}") for label, name in _CREATIVE_COMMONS),
)
